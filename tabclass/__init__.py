"""tabclass: multi-class tabular classification as Spark DataFrame / SQL / ML jobs.

Sub-packages
------------
sources    table scans, registry lookups, sinks (keyed upsert, replace by key, CSV,
           run log) and the model store
functions  column-level helpers: seeded hashing, list/JSON parsing, row-wise argmax,
           two-level exact ranking, exact distributed quantiles, running sums
operators  preparation, class balance, splits and folds, label encoding, imputing,
           re-sampling (under / over / SMOTE), nearest neighbours, naive Bayes,
           Spark ML learners, hyper-parameter search, scoring
plans      evaluation plans built on one confusion-matrix aggregate (reports,
           F-beta, percentile buckets), curves and AUC, describe tables, the
           model registry and the end-to-end train / score jobs
streaming  scoring a stream with a stored model
"""

__all__ = ["config", "session"]
