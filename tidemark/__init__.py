"""Market snapshots, form intake, identity matching and position attribution on Spark."""

__version__ = "0.1.0"
