"""Awkward documents, and what operators should give, worked out the plain way."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "digest string, kept string, n_words string, `row` string, `key` string, sign string, "
    "size string, block string, hot_id string, own_id string"
)
EXTRA = ("x",) * 9 + (None,)


def words(text):
    return WORD.findall(text or "")


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def awkward(seed=3, n=60):
    """Texts with copies, near copies, shared passages, odd white space, nulls and repeats."""
    rng = random.Random(seed)
    vocabulary = [a + b + c for a in ("ba", "to", "é", "Zu") for b in ("k", "rim", "ß") for c in ("a", "en", ".")]
    passage = " ".join(rng.choices(vocabulary, k=40))
    rows = []
    for i in range(n):
        body = rng.choices(vocabulary, k=rng.choice((0, 1, 3, 12, 13, 30, 120)))
        if i % 4 == 0:
            at = rng.randint(0, len(body))
            body[at:at] = passage.split()
        gap = rng.choice((" ", " ", "  ", "\n", "\t \n", "\x0b"))
        rows.append((i, gap.join(body), rng.choice(("en", "de", None)), rng.choice(("s1", "s2", "s10", None)), len(body)))
    texts = [r[1] for r in rows if len(r[1].split()) > 100][:4]
    for k, t in enumerate(texts):  # exact copies, case copies, near copies
        rows.append((n + 10 * k, t, "en", "s1", 0))
        rows.append((n + 10 * k + 1, t.upper().replace("É", "é").replace("SS", "ß"), "en", "s1", 0))
        rows.append((n + 10 * k + 2, t + " extra", "en", "s2", 0))
        rows.append((n + 10 * k + 3, t.replace(t.split()[50], "other", 1), "en", "s2", 0))
    rows += [
        (500, None, None, None, None),
        (501, "", "en", "s1", 0),
        (502, " \n\t ", "en", "s1", 3),
        (503, "word " * 20_000, "en", "s1", 100_000),
        (504, "a" * 50_000, "en", "s1", 50_000),
        (505, "nbsp inside   wide \x1c and <|endoftext|>", "en", "s1", 1),
        (506, texts[0], "en", "s1", 1),
        (506, texts[0], "en", "s1", 1),  # a repeated row
        (507, texts[0], "en", "s1", 1),
        (507, texts[1], "en", "s1", 1),  # one doc_id, two texts
        (None, texts[1], "en", "s1", 1),
        (None, "no id here", "en", "s9", 1),
    ]
    return rows


def ids_of(text, tokenizer):
    return tokenizer.encode(text or "", add_special_tokens=False).ids
