from lodeworks.streaming.token_counts import latest_counts, start_prefix_counts
from lodeworks.streaming.trends import start_window_counts, trend, window_counts

__all__ = ["latest_counts", "start_prefix_counts", "start_window_counts", "trend", "window_counts"]
