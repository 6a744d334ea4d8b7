"""Small documents that hold every awkward case, and a few brute-force rules."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tag long, row string, id string, kept boolean"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n):
    r = random.Random(seed)
    syllables = ["th", "er", "on", "an", "re", "ti", "é", "ing", "ou", "ß"]
    return " ".join("".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(n))


def texts():
    base = [prose(s, 60 + 7 * s) for s in range(12)]
    edited = []
    for s, t in enumerate(base[:6]):
        w = t.split(" ")
        w[5] = "changed"
        edited.append(" ".join(w))
    near_edge = base[0].split(" ")[:-3]
    odd = [None, "", "   \t\n", "one", "One", "ONE two", "one  two\n", "a b c", "\u00a0", "x\x0by", "a\x1cb c"]
    again = [base[3], base[3].replace(" ", "\n"), base[3].upper(), base[4] + " ", base[4]]
    repeated = [" ".join(["same words come again here"] * 9), "line one is here\nline one is here\n\nother line\n" * 3]
    junk = ["#*$ " * 40, "SHOUT!! " * 30, " | ".join(base[1].split(" ")[:60])]
    long = [" ".join(prose(90 + k, 200) for k in range(60))]
    return base + edited + [" ".join(near_edge)] + odd + again + repeated + junk + long


def rows():
    out = []
    for i, t in enumerate(texts()):
        lang = [None, "en", "fr"][i % 3]
        out.append((i, t, lang, None if i % 7 == 0 else f"src{i % 2}", None, 5, "row", "id", True))
    out.append(out[3])  # a repeated row
    out.append((None, base_text(), "en", "src0", 1, 5, "row", "id", False))  # without an id, text of row 2
    out.append((None, None, None, None, None, None, None, None, None))
    return out


def base_text():
    return texts()[2]


def documents(spark, partitions=5):
    return spark.createDataFrame(rows(), SCHEMA).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
