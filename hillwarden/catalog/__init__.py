"""All registered queries; importing this package fills the registry."""

from . import field_queries, message_queries, office_queries, sensor_queries, stream_queries, table_queries  # noqa: F401
from .registry import COVERS, ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES", "COVERS"]
