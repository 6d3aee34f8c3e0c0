"""All named queries. Importing the modules registers them."""

from lapframe.catalog import alignment, files, metrics, models, streams, tables, tracks, windows  # noqa: F401
from lapframe.catalog.registry import ENTRIES  # noqa: F401
