from millrace.functions.ratio import band, pct
from millrace.functions.time import micros_to_ntz, naive_utc, start_of_hour

__all__ = ["band", "micros_to_ntz", "naive_utc", "pct", "start_of_hour"]
