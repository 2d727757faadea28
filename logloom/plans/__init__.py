from .pipeline import run, stage_logs

__all__ = ["run", "stage_logs"]
