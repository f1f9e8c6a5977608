"""Change capture and snapshot synchronisation of text objects on Spark."""

from snapsync.settings import Settings

__all__ = ["Settings"]
