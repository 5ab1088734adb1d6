"""Things a Python worker keeps between tasks."""

from __future__ import annotations


def kept(name: str, make):
    """An object made once per worker process, however often the calling function is shipped to it."""
    import sys
    import types

    holder = sys.modules.setdefault("millrace_kept", types.ModuleType("millrace_kept"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)
