"""wideloom: unsupervised analytics for wide numeric tables on Apache Spark."""

__version__ = "0.1.0"
