"""Plain versions of the operators, for small inputs."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None, sources=None, langs=None, extra=""):
    """A documents table; ``extra`` adds a column with a clashing name."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, langs[k] if langs else "en", sources[k] if sources else "s", len(t or ""))
            for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    df = spark.createDataFrame(rows, KIND)
    for name in extra.split():
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def components(texts, width=5, pct=75):
    sets = [shingles(t, width) for t in texts]
    label = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= pct * len(sets[a] | sets[b]):
            x, y = sorted((label[a], label[b]))
            label = [x if v == y else v for v in label]
    return label


def kept_bytes(rows, length=50):
    """(n_removed, n_spans, kept) for (id, text) rows."""
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        for p in range(len(raw) - length + 1):
            s = raw[p:p + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if first[raw[p:p + length]] < i:
                gone[p:p + length] = b"\x01" * length
        runs = [k for k, _ in itertools.groupby(gone) if k]
        out.append((sum(gone), len(runs), bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    return out


def kept_lines(rows, min_chars=20, min_docs=3):
    key = lambda line: low(line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                holders[k].append(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines
                if len(holders[key(x)]) < min_docs or i == max(holders[key(x)])]
        out.append((len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def phrase_hits(text, items, width=10):
    """(n_words, n_hit, ids of items found)."""
    words, hit, found = item_words(text), set(), set()
    for item, t in items:
        test = item_words(t)
        n = min(width, len(test))
        for window in {tuple(test[i:i + n]) for i in range(len(test) - n + 1)} if n else ():
            for p in range(len(words) - n + 1):
                if tuple(words[p:p + n]) == window:
                    hit.update(range(p, p + n))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def near_items(text, items, width=10, near=15):
    words, found = item_words(text), set()
    for item, t in items:
        test = item_words(t)
        n = min(width, len(test))
        for i in range(len(test) - n + 1) if n else ():
            wanted = set(test[i:i + n])
            if any(wanted <= set(words[p:p + near]) for p in range(len(words))):
                found.add(item)
    return len(found)


def quality_base(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:], strict=False))
               if windows[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def sha256(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()
