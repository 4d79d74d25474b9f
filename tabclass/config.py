"""Typed job configuration (replaces free-text parameters; see README)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the reference's for the same results.
IMBALANCE_LIMIT = 0.10            # class imbalance when min/max share is below this
UNDER_SAMPLING_FLOOR = 10000      # under-sampling allowed when the result exceeds this
DEFAULT_MODELS = ("rf", "xg")     # model families searched by default
DEFAULT_KFOLD = 5
VALIDATION_SHARE = 0.33
SPLIT_SEED = 1
TRIALS_GRID = {"xg": 40, "rf": 20}  # random draws per combo with grid search on
BREAKDOWN_CUTS = (0.99, 0.95, 0.90, 0.75, 0.50, 0.25, 0.0)
PRECISION_BUCKET_CUTS = (0.99, 0.98, 0.97, 0.96, 0.95, 0.90, 0.85, 0.80, 0.75, 0.70,
                         0.65, 0.60, 0.55, 0.50, 0.45, 0.40, 0.35, 0.30, 0.25, 0.20,
                         0.15, 0.10, 0.05, 0.0)
TS_FORMAT = "dd/MM/yyyy HH:mm:ss"
UNKNOWN_LABEL = "<unknown>"
MISSING_TARGET = "nan"
ABSENT_ACTUAL = "NA"


@dataclass(frozen=True)
class JobConfig:
    historic_table: str
    prediction_table: str
    target: str
    id_col: str
    model_id: str
    accuracy_focus: str = "f1"            # precision | recall | accuracy | anything else = F1
    target_focus: tuple[str, ...] = ("all",)
    preferred_model: str = ""             # "<model>_<sampling>" or ""
    models: tuple[str, ...] = DEFAULT_MODELS
    show_probability: bool = True
    is_gridsearch: bool = True
    is_update_model_param: bool = True
    persist_model: bool = True
    read_model: bool = False
    cv_kfold: int = DEFAULT_KFOLD
    model_location: str = ""
    cv_score_table: str | None = None
    cl_report_table: str | None = None
    precision_buckets_table: str | None = None
    registry_table: str = "hyper_parameters"
    top_vars_table: str = "top_vars"
    seed: int = SPLIT_SEED
    max_trials: dict = field(default_factory=lambda: dict(TRIALS_GRID))

    @property
    def beta(self) -> float:
        return {"precision": 0.5, "recall": 2.0}.get(self.accuracy_focus, 1.0)

    @property
    def preferred(self) -> tuple[str, str] | None:
        if not self.preferred_model:
            return None
        m, s = self.preferred_model.split("_", 1)
        return m, s

    def focus_labels(self) -> tuple[str, ...] | None:
        """Focus labels, or None for 'all' (every class)."""
        f = tuple(x.strip().lower() if x.strip().lower() == "all" else x.strip()
                  for x in self.target_focus)
        return None if not f or f[0] == "all" else f
