"""Small tables with the awkward cases: nulls, empty and long texts, ties,
repeated rows and columns whose names the operators use themselves."""

import random
import re

WORD = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, fp long, kept string, n long"


def words(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", "", ",", "."]) for _ in range(n)]


def row(doc_id, text, source="src0"):
    return (doc_id, text, "en", source, None if text is None else len(text), 7, None, "clash", 1)


def texts():
    """(id, text) pairs; ids from 20 on hold copies, near copies and shared passages."""
    passage = " ".join(words("passage", 120))
    base = words("base", 300)
    near = list(base)
    near[150] = "changed"
    out = [(0, None), (1, ""), (2, "  \t\n "), (3, "a"), (4, "a b"), (5, "A  B"), (6, "é ß 漢字 x\u0085y"),
           (7, " ".join(words("long", 6000))), (8, "same same same " * 60), (9, "x" * 3000),
           (10, "one\ntwo\none\n\n \none"), (11, " leading and trailing "), (12, " leading\tand trailing\n"),
           (13, "###*** $$$ %%% &&& ||| <<< >>> a b c d"), (14, " ".join(words("alone", 25)))]
    out += [(20, " ".join(base)), (21, " ".join(base)), (22, "  ".join(base)), (23, " ".join(near)), (24, "\n".join(base))]
    out += [(30 + k, " ".join(words(k, 20 + 40 * k)) + " " + passage + " " + " ".join(words(100 + k, 30))) for k in range(8)]
    return out + [(38, passage), (39, passage + " " + passage)]


def documents(spark, rows=None):
    rows = [row(i, t, f"src{(i or 0) % 3}") for i, t in texts()] if rows is None else rows
    return spark.createDataFrame(rows, DOCS).repartition(5)


def split_words(text):
    return re.findall(WORD, text or "")
