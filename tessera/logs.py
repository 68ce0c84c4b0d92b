"""Driver logs: console and a file named by the time, and timed steps."""

from __future__ import annotations

import logging
import os
import sys
import time
from contextlib import contextmanager

LOG = logging.getLogger("tessera")


def set_up(folder: str | None = None, level: int = logging.INFO) -> str | None:
    """Log to the console and, if a folder is named, to a new file in it; returns the file's path."""
    form = logging.Formatter("%(asctime)s %(levelname)s %(message)s")
    handlers: list[logging.Handler] = [logging.StreamHandler(sys.stderr)]
    path = None
    if folder:
        os.makedirs(folder, exist_ok=True)
        path = os.path.join(folder, time.strftime("run-%Y%m%d-%H%M%S.log"))
        handlers.append(logging.FileHandler(path, encoding="utf-8"))
    for old in list(LOG.handlers):
        LOG.removeHandler(old)
    for h in handlers:
        h.setFormatter(form)
        LOG.addHandler(h)
    LOG.setLevel(level)
    return path


@contextmanager
def step(name: str, seconds: dict | None = None):
    """Log the start, end and length of a step; a failed step is logged as such and goes on failing."""
    began = time.time()
    LOG.info("%s ...", name)
    try:
        yield
    except Exception:
        LOG.exception("%s failed after %.1f s", name, time.time() - began)
        raise
    took = round(time.time() - began, 1)
    if seconds is not None:
        seconds[name] = took
    LOG.info("%s took %.1f s", name, took)
