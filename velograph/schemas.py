"""Record layouts of the two text inputs."""

# Column names, order and types of the trip and edge files.
TRIP_SCHEMA = """
    start_time STRING, stop_time STRING, trip_duration INT,
    start_station_id BIGINT, start_station_name STRING,
    start_station_latitude FLOAT, start_station_longitude FLOAT,
    stop_station_id BIGINT, stop_station_name STRING,
    stop_station_latitude FLOAT, stop_station_longitude FLOAT,
    bike_id BIGINT, user_type STRING, birth_year INT, gender INT, trip_id BIGINT
"""
EDGE_SCHEMA = "source BIGINT, target BIGINT, weight INT"
