from gradewise.plans.experiment import (
    ExperimentConfig,
    ExperimentResult,
    Prepared,
    prepare,
    run_experiment,
    run_experiment_file,
    write_reports,
)

__all__ = [
    "ExperimentConfig",
    "ExperimentResult",
    "Prepared",
    "prepare",
    "run_experiment",
    "run_experiment_file",
    "write_reports",
]
