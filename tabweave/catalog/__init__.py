"""The registered driver queries."""

from tabweave.catalog import explain, features, metrics, models, quality, scoring, sources, splits  # noqa: F401
from tabweave.catalog.base import QUERIES, SQL  # noqa: F401
