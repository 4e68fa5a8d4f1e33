"""Flood-risk analytics as Spark jobs: gridded, point and observed flood data in, one alert per watershed and run out."""
