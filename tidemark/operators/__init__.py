"""Operators on candle series: resampling, validation, cleaning, gaps, joins."""
