from trolley.streaming.incremental import start_incremental_load

__all__ = ["start_incremental_load"]
