"""Rows that every operator must take: nulls, empty and long texts, repeats, odd characters."""

AWKWARD = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, " \t\n ", None, "b"),
    (4, "x", "de", "a"),
    (4, "x", "de", "a"),
    (None, "one two three four five six", "en", "a"),
    (5, "word " * 30_000, "en", "c"),
    (6, "snow ☃ and \U0001f600 ▁ ends\x00here", None, None),
]
