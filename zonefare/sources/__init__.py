from zonefare.sources.tables import read_table
from zonefare.sources.rides import rides, zone_dim

__all__ = ["read_table", "rides", "zone_dim"]
