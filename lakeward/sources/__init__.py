"""Entity specs, raw-table readers and the test-data stand-ins."""

from lakeward.sources.readers import DriverTables, raw_path, read_raw
from lakeward.sources.schemas import ENTITIES, LINEAGE, EntitySpec

__all__ = ["DriverTables", "ENTITIES", "EntitySpec", "LINEAGE", "raw_path", "read_raw"]
