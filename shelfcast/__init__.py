"""shelfcast: retail demand analytics as Spark DataFrame operators and batch jobs."""

from shelfcast.spec import DemandSpec

__all__ = ["DemandSpec"]
