"""Logging of the driver's side."""

from __future__ import annotations

import logging


def configure(level: int | str = logging.INFO) -> None:
    """One handler on the package's logger, however often it is called."""
    logger = logging.getLogger("tallyward")
    if not logger.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
        logger.addHandler(handler)
    logger.setLevel(level)
