"""The same operators over a stream of transactions."""
