"""Awkward document tables and brute-force versions shared by the tests."""

import hashlib
import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def rows(texts, source="s"):
    return [(i, t, "en", source, None if t is None else len(t)) for i, t in enumerate(texts)]


def sentence(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward_texts(seed=1):
    """Nulls, empty and blank texts, ties, long texts, copies, near copies, shared passages, odd characters."""
    rng = random.Random(seed)
    base, passage = sentence(rng, 200), sentence(rng, 60)
    near = base.split()
    near[100] = "changed"
    far = base.split()
    for at in range(0, 200, 9):
        far[at] = f"other{at}"
    return [
        None, "", "   \n\t ", "one", "one two three", "one two three", base, base, " ".join(near), " ".join(far), base.upper(),
        sentence(rng, 30) + " " + passage + " " + sentence(rng, 30), passage + "\n" + sentence(rng, 50), sentence(rng, 40) + " " + passage,
        "é ü ñ " * 60, "a" * 700, "ab " * 300, "line\nline\nline\n\nother line\n", sentence(rng, 6000), sentence(rng, 25), "x\x0by\x0cz\rq 🙂 " * 12,
        passage + " " + passage, "# $ % | " * 20, sentence(rng, 19), sentence(rng, 20),
    ]


def components(links, ids):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingles(text, size=5):
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return set()
    return {tuple(found[i:i + size]) for i in range(max(1, len(found) - size + 1))}


def without_repeats(texts, units, join, window):
    """(n, removed, kept digest, spans) of each text, by a dictionary of all windows."""
    seen, out = set(), []
    for text in texts:
        own = units(text)
        gone = [False] * len(own)
        for i in range(len(own) - window + 1):
            key = bytes(own[i:i + window]) if isinstance(own, bytes) else tuple(own[i:i + window])
            if key in seen:
                gone[i:i + window] = [True] * window
            seen.add(key)
        kept = join([x for x, y in zip(own, gone) if not y])
        spans = sum(1 for i, y in enumerate(gone) if y and (i == 0 or not gone[i - 1]))
        out.append((len(own), sum(gone), hashlib.sha256(kept).hexdigest(), spans))
    return out
