"""Named queries of the engine and the SQL that states the same result."""

from libretto.plans import registry

__all__ = ["registry"]
