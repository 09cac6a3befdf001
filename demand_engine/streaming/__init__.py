"""Streaming entry points.

The batch operators are reused on streaming DataFrames; nothing here adds
new semantics. ``store_weekly_stream`` keeps the store-week sum current as
sales files arrive, with a watermark so its state stays bounded.
"""

from .store_weekly import store_weekly_stream  # noqa: F401
