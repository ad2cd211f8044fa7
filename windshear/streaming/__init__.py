"""The ETL over a file stream: new flight files extend the stored mart."""

from windshear.streaming.ingest import flight_stream, start_mart_stream

__all__ = ["flight_stream", "start_mart_stream"]
