"""Fixed values and run parameters shared by all operators."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# Fixed values (must stay equal to the oracle SQL and the published formats):
# host role flag, own-row flag and its opposite, program code written with
# touched properties, audit user of batch writes, canonical code pattern of
# the fixtures (one capital P then six digits or more).
HOST_ROLE = "H"
OWN_FLAG = "Y"
NOT_OWN_FLAG = "N"
PROGRAM_CODE = "MRC"
AUDIT_USER = "batch"
CODE_PATTERN = "P[0-9]{6,}"

# Change keys of the config and compset tables: a pair is
# (property, competitor); seasons are not part of the key.
PAIR_KEYS = ("prop_code", "competitor_id")


@dataclass(frozen=True)
class RunContext:
    """One clock read and one id per run; every stamp in the run uses these."""

    run_id: int = 1
    run_ts: _dt.datetime = field(default_factory=lambda: _dt.datetime(2024, 1, 1, 0, 0, 0))
    data_date: _dt.date = field(default_factory=lambda: _dt.date(2024, 1, 1))
    user: str = AUDIT_USER

    @classmethod
    def now(cls, run_id: int, data_date: _dt.date | None = None) -> "RunContext":
        ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)
        return cls(run_id=run_id, run_ts=ts, data_date=data_date or ts.date())
