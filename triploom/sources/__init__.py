"""Where trip records come from and where the star tables live."""

from triploom.sources.csv_trips import read_trips, stream_trips  # noqa: F401
from triploom.sources.fixture import trips_from_tables, read_table  # noqa: F401
