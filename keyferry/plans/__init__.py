from .audit import Audit
from .run import FrameRun, LoadConfig, StoreRun
from .steps import FULL_RUN, STEPS, run_step, run_steps
from .tables import TABLES, load_order

__all__ = ["Audit", "FULL_RUN", "FrameRun", "LoadConfig", "STEPS", "StoreRun", "TABLES", "load_order", "run_step", "run_steps"]
