"""The queries registered for checking, by operator family."""

from importlib import import_module

from tidemark.workloads.registry import WORKLOADS, Workload

_FAMILIES = ("scans", "shaping", "changes", "links", "marks", "syncs", "landings")


def all_workloads() -> dict[str, Workload]:
    for family in _FAMILIES:
        import_module(f"{__name__}.{family}")
    return dict(WORKLOADS)
