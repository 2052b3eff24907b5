"""Explicit schemas: no inference pass, no type drift between runs."""

from __future__ import annotations

# Indexed ratings. Indices are whole numbers stored as doubles, as indexers emit them.
RATINGS = (
    "asin string, asin_index double, overall double, "
    "reviewerID string, reviewerID_index double, title string"
)

BOOKS = "asin string, title string, imUrl string, description string, price double"

REVIEWS = (
    "asin string, reviewerID string, reviewerName string, "
    "summary string, reviewText string, overall double"
)

AVERAGE_RATING = "asin string, title string, average_rating double, price double"

FEEDBACK_RAW = "user_id int, book string, rating string"

RECOMMENDATIONS = (
    "reviewerID_index int, recommendations array<struct<asin_index: int, rating: float>>"
)
