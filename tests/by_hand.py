"""The text rules once more, character by character, to check the expressions."""

from itertools import groupby

MARKS = ".,:!?;"
KEPT = MARKS + "'$%"
SCHEMES = ("http://", "https://", "www.")


def is_word(c):
    return c.isalnum() or c == "_"


def is_other(c):
    return not is_word(c) and c not in KEPT


def collapse(text):
    out = []
    for c, run in groupby(text):
        n = len(list(run))
        out.append(f" {c} " if c in ".!?," and n > 1 else c * n)
    return "".join(out)


def drop_urls(text):
    out, i = [], 0
    while i < len(text):
        start = i + 1 if text[i] == "(" and text.startswith(SCHEMES, i + 1) else i
        if text.startswith(SCHEMES, start):
            i = start
            while i < len(text) and not text[i].isspace():
                i += 1
            out.append(" ")
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def detach(text):
    ends = text[1:] + " "
    return "".join(
        f" {c} " if c in MARKS and after == " " else c
        for c, after in zip(text, ends, strict=False)
    )


def drop_strays(text):
    def at(i):
        return text[i] if 0 <= i < len(text) else " "

    out = []
    for i, c in enumerate(text):
        before, after = at(i - 1), at(i + 1)
        if c == "$":
            stray = not after.isdecimal()
        elif c == "%":
            stray = not before.isdecimal()
        else:
            stray = is_other(c) and not (is_word(before) and is_word(after))
        out.append(" " if stray else c)
    return "".join(out)


def normalise(text):
    text = "".join(" " if c in "\r\n\t" else c for c in text)
    text = drop_strays(detach(drop_urls(collapse(text)).strip()))
    return " ".join(part for part in text.replace("(", " ").split(" ") if part).lower()


def unigrams(normalised):
    out, i = [], 0
    while i < len(normalised):
        window = normalised[i : i + 3]
        if len(window) == 3 and window[0] == window[2] == " " and window[1] in MARKS:
            out.append(" ")
            i += 3
        else:
            out.append(normalised[i])
            i += 1
    text = "".join(out)
    return text[:-2] if len(text) > 1 and text[-2] == " " and text[-1] in MARKS else text


def ngrams(normalised, n):
    words = normalised.split()
    windows = [words[i : i + n] for i in range(len(words) - n + 1)]
    lone = set(MARKS)
    return ["_".join(window) for window in windows if not lone & set(window)]


def words(text):
    n = normalise(text)
    parts = [unigrams(n), " ".join(ngrams(n, 2)), " ".join(ngrams(n, 3))]
    return " ".join(parts).split(" ")
