"""What Python workers keep from one task to the next."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType
from typing import Any


def of_worker(name: str, key: Any, make: Callable[[Any], Any]) -> Any:
    """``make(key)``, kept under ``name`` while the Python worker lives and the key stays the same.

    Functions travel to workers by value, so their own modules (and caches in them) end with each
    task; this place belongs to the process. A decorated cache would be looked up by its module, which executors need not have.
    """
    held = sys.modules.setdefault("_notewright_worker", ModuleType("_notewright_worker")).__dict__
    if name not in held or held[name][0] != key:
        held[name] = (key, make(key))
    return held[name][1]
