from tidemark.plans.jobs import (
    ALBUMS,
    TRACKS,
    bronze_bytes,
    bronze_text_bytes,
    land,
    read_bronze,
    run,
    silver_albums,
    silver_tracks,
)

__all__ = [
    "ALBUMS",
    "TRACKS",
    "bronze_bytes",
    "bronze_text_bytes",
    "land",
    "read_bronze",
    "run",
    "silver_albums",
    "silver_tracks",
]
