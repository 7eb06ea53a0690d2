"""Physical choices: expression vs Arrow kernels, persistence, local sessions."""

from lodestar.plans.config import local_session
from lodestar.plans.physical import EXPR_MAX_TERMS, MAX_CENTER_NUMBERS, choose_form
from lodestar.plans.storage import checkpoint_dir, local_frame, prepared, spread

__all__ = [
    "EXPR_MAX_TERMS",
    "MAX_CENTER_NUMBERS",
    "checkpoint_dir",
    "choose_form",
    "local_frame",
    "local_session",
    "prepared",
    "spread",
]
