"""Documents with every odd case, and brute-force versions."""

import random
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()) + str(rng.randint(0, 60)) for _ in range(n))


def corpus(n=60, seed=3):
    """Random prose, exact and near copies, shared passages, and odd rows."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.choice([20, 60, 120, 300])) for _ in range(n)]
    base = prose(rng, 200).split(" ")
    for k in range(25):
        w = list(base)
        for _ in range(rng.randint(1, 12)):
            w[rng.randrange(len(w))] = f"edit{rng.randint(0, 10**6)}"
        texts.append(" ".join(w))
    texts += [texts[0]] * 5 + [texts[1].upper()] * 2
    passage = prose(rng, 70)
    for k in range(12):
        texts.append(prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 40))
    odd = [None, "", "   \n\t ", "one two three", "One  two\nthree", "a", "word " * 400, "né\u00a0o x\x0by", "x" * 5000]
    rows = list(enumerate(texts + odd))
    rng.shuffle(rows)
    return [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in rows]


def words(text, lower=False):
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def shingles(text, k=5):
    w = words(text, True)
    return {b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({b" ".join(w)} if w else set())


def brute_components(rows, num=75, den=100):
    sets = {d: shingles(t) for d, t, *_ in rows}
    parent = {d: d for d in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    at = defaultdict(list)
    for d, s in sets.items():
        meets = Counter(e for x in s for e in at[x])
        for e, c in meets.items():
            if den * c >= num * (len(s) + len(sets[e]) - c):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
        for x in s:
            at[x].append(d)
    return {d: (len(sets[d]), find(d)) for d in sets}


def brute_repeats(rows, n=50):
    """Word places covered by n-word runs that another document has."""
    at = defaultdict(set)
    for d, t, *_ in rows:
        w = words(t)
        for i in range(len(w) - n + 1):
            at[tuple(w[i : i + n])].add(d)
    out = set()
    for d, t, *_ in rows:
        w = words(t)
        for i in range(len(w) - n + 1):
            if len(at[tuple(w[i : i + n])]) > 1:
                out.update((d, j) for j in range(i, i + n))
    return out
