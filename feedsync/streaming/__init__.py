from feedsync.streaming.feed_stream import start_feed_stream

__all__ = ["start_feed_stream"]
