"""Imports every query module so that their ``register`` calls run."""

from marketlake.plans import path_queries  # noqa: F401
from marketlake.plans import state_queries  # noqa: F401
from marketlake.plans import market_queries  # noqa: F401
from marketlake.plans import pair_queries  # noqa: F401
from marketlake.plans import book_queries  # noqa: F401
from marketlake.plans import staging_queries  # noqa: F401
from marketlake.plans import ingest_queries  # noqa: F401
from marketlake.plans import more_queries  # noqa: F401
