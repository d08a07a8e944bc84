"""Whole jobs: one incremental load, a run over many feeds, the promotion list, and the feeds themselves."""
