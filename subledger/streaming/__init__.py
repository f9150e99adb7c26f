from subledger.streaming.quarantine_stream import start as start_quarantine_stream

__all__ = ["start_quarantine_stream"]
