"""``python -m feedsync ...`` runs one reconciliation (see feedsync.plans.job)."""

from feedsync.plans.job import main

main()
