"""Rows that every operator must take."""

#: Null, empty, blank, repeated, tied, odd and long texts.
EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (4, "a"), (5, "Ünï cödé \U0001f642 ȩ́"), (6, "x" * 30000), (7, "one two three four five six " * 3000),
        (None, "a row without an id that has some words"), (8, "\x01\x02 control \x1c \x85   marks"), (9, "one two three four five six " * 3000)]
