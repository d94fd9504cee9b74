"""Conversation-archive analytics on Spark DataFrames."""
