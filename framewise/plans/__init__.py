"""Query catalog: importing this package registers every query key."""

from . import (geometry_queries, io_queries, label_queries, ml_queries,  # noqa: F401
               pixel_queries, quality_queries, stream_queries, survey_queries)
from .catalog import ORACLE, QUERIES  # noqa: F401
