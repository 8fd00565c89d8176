"""Plain versions of what the operators compute, for small tables."""

import math
import random
import re
from collections import Counter

BLANKS = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return BLANKS.findall((text or "").encode())


def shingles(text, width):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def components(rows, width, percent):
    """{position: (set size, smallest id reachable)} of rows (id, text), by comparing all pairs."""
    sets, parent = [shingles(t, width) for _, t in rows], list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return {i: (len(sets[i]), least.get(find(i)) if rows[i][0] is not None else None) for i in range(len(rows))}


def unigram_scores(texts, training):
    """(n_tokens, n_known, tokens in training, base score) of each text."""
    tokens = lambda t: [w.lower() for w in words(t)] + [None]
    counts = Counter(w for t in training for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    base = lambda w: math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1)))
    return [(len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total, sum(map(base, tokens(t)))) for t in texts]


def quality_numbers(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text, w = text or "", words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    repeated = {i + j for i, x in enumerate(windows) if often[x] > 1 for j in range(3)}
    return (
        len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)
    )


def contains(text, item):
    plain = lambda t: " " + " ".join(re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]", " ", (t or "").casefold()).split()) + " "
    return len(plain(item)) > 2 and plain(item) in plain(text)


VOCABULARY = [a + b + c for a in ("ka", "to", "mi", "re", "lu", "é") for b in ("n", "s", "lt", "ß") for c in ("a", "o", "ist", "en", "ung")]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) + (rng.choice(VOCABULARY) if rng.random() < 0.5 else "") for _ in range(n))


def runs(words, least=24, times=3):
    """(start, length, period) of all runs, by trying every period."""
    found, spans = [], set()
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            span = (i, j - i + q)
            if j > i and span[1] >= max(least, times * q) and span not in spans:
                spans.add(span)
                found.append((*span, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def trie(conversations):
    """{(smallest member, depth): (parent, members, children, leaves, saved words, ends)} of {id: [(role, text), ...]}."""
    members, children = {}, {}
    for key, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(key)
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        below = children.get(prefix, [])
        leaves[prefix] = sum(leaves[c] for c in below) or 1
        saved[prefix] = sum(saved[c] for c in below) + (len(members[prefix]) - 1) * (len(words(prefix[-1][1])) if prefix else 0)
    return {
        (min(keys), len(p)): (
            min(members[p[:-1]]) if p else None, len(keys), len(children.get(p, [])), leaves[p], saved[p],
            ",".join(map(str, sorted(k for k in keys if len(conversations[k]) == len(p)))),
        )
        for p, keys in members.items()
    }


def without_shared_lines(rows, least_documents=10, least_chars=1):
    """(n_lines, n_dropped, kept text) of each text."""
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    counts = Counter(k for t in rows for k in {key(line) for line in (t or "").split("\n")})
    stays = lambda line: len(key(line)) < least_chars or counts[key(line)] < least_documents
    found = [((t or "").split("\n"), [line for line in (t or "").split("\n") if stays(line)]) for t in rows]
    return [(len(a), len(a) - len(b), "\n".join(b)) for a, b in found]
