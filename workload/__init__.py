"""The queries registered with the driver, each with its SQL counterpart if it has one."""

from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
