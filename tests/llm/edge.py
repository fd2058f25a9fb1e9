"""Rows every operator has to survive: nulls, empty and odd texts, repeated rows and ids."""

NASTY = [
    (900001, None),
    (900002, ""),
    (900003, "   \n\t "),
    (900004, "one"),
    (900005, "   ünïcödé 日本語 🙂 é ﻿"),
    (900006, "\x00 nul \x1c and \x85 controls"),
    (900007, "x" * 5000),
    (900008, "same words " * 400),
    (900008, "same words " * 400),
    (900009, "repeated id, first text"),
    (900009, "repeated id, second text"),
    (None, "a text without an id"),
    (None, None),
    (-5, "negative id"),
]
