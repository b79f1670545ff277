"""Rows with everything that real tables get wrong."""

import random

# Names that the operators use inside, as extra columns of the input.
CLASHES = ["row", "key", "h", "t", "g", "id", "slot", "shard", "epoch", "spans", "score", "label", "fingerprint", "size",
           "bucket", "component_id", "lines", "chunk", "kept", "distance"]


def word(rng):
    return "".join(rng.choice(["ta", "ri", "é", "mo", "nu", "sh"]) for _ in range(rng.randint(1, 4)))


def prose(rng, words):
    """Words in lines of about ten."""
    return "".join(word(rng) + (".\n" if rng.random() < 0.1 else " ") for _ in range(words)).strip()


def messy_rows():
    rng = random.Random(11)
    base = [prose(rng, 120) for _ in range(12)]
    passage = prose(rng, 60)
    texts = [None, "", " \n\t ", "one", "one", "one two three", base[0], base[0], base[0] + " end", base[1],
             "\n".join([base[2], passage, base[3]]), "\n".join([base[4], passage]), passage, prose(rng, 30_000),
             "x " * 3_000, base[5].upper(), "a\x0bb\x0cc\rd\x1ce\u2003f", *base[6:]]
    rows = [(i, text, ["en", "de", None][i % 3], "hot" if i % 2 else [None, "a", "b"][i % 3], len(text or ""))
            for i, text in enumerate(texts)]
    rows.append(rows[9])  # a row that is repeated
    rows.append((9, "same id, other text", "en", "a", 19))
    rows.append((None, base[0], "en", "hot", 0))
    rows.append((None, None, None, None, None))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
