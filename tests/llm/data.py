"""Small made-up texts for the brute-force tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed: int = 3, n: int = 60) -> list[tuple]:
    """Random texts with copies, near copies, shared passages, odd white space and long words."""
    r = random.Random(seed)
    voc = ["the", "Of", "and", "été", "schön", "x" * 40] + ["".join(r.choice("abcde") for _ in range(r.randint(1, 9))) for _ in range(400)]
    text = lambda k: " ".join(r.choice(voc) for _ in range(k))
    shared = [text(60) for _ in range(3)]
    out = [None, "", " \n\t", "a", "a b", "a b", "a b c", "b c a"]
    while len(out) < n:
        kind = r.random()
        if kind < 0.3:
            out.append(text(r.randint(0, 150)))
        elif kind < 0.5:
            out.append(text(r.randint(0, 60)) + "\n" + r.choice(shared) + "\n" + text(r.randint(0, 60)))
        elif kind < 0.65:
            out.append(r.choice([x for x in out if x]))
        elif kind < 0.85:
            w = r.choice([x for x in out if x and len(x.split()) > 20] or [text(80)]).split()
            w[r.randrange(len(w))] = "edited"
            out.append(r.choice([" ", "  ", "\t"]).join(w))
        elif kind < 0.95:
            out.append("ab " * r.randint(1, 200))
        else:
            out.append("a" * r.randint(0, 700))
    return [(i, t, r.choice(["en", "de", None]), r.choice(["s1", "s2", None]), len(t or "")) for i, t in enumerate(out)]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)
