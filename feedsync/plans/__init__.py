from feedsync.plans.views import MatchRules, Reconciliation, SkewConf, reconcile_views

__all__ = ["MatchRules", "Reconciliation", "SkewConf", "reconcile_views"]
