"""Rows of the small test tables."""


def doc(i, text, lang="en", source="s0"):
    return (i, text, lang, source, None if text is None else len(text))


#: NULLs in every column, empty and blank texts, repeated rows, ties, one very long text.
ODD = [
    doc(1, "alpha beta gamma delta epsilon zeta"),
    doc(2, "alpha beta gamma delta epsilon zeta"),
    doc(2, "alpha beta gamma delta epsilon zeta"),
    doc(None, "alpha beta gamma delta epsilon zeta"),
    doc(None, None, None, None),
    doc(3, None),
    doc(4, ""),
    doc(5, " \n\t "),
    doc(6, "one", None, None),
    doc(7, "ünï cödé 日本 😀\nalpha", "de", "s1"),
    doc(8, "very long text " * 20000, "en", "s2"),
    doc(9, "x" * 60000, "en", "s2"),
    doc(10, "a  b\tc\x0bd", "en", None),
    doc(11, "a b c d", "en", "s1"),
]
