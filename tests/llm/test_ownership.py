"""Secrets against brute force: base spans by plain scanning, ownership by dictionaries over the whole table."""

import hashlib
import random
import re
from collections import defaultdict

from lodestone.llm import secrets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table_rows():
    rng = random.Random(11)
    key = lambda n, a: "".join(rng.choice(a) for _ in range(n))
    hexes, mixed = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    common, own, placeholder = key(40, hexes), [key(40, mixed) for _ in range(30)], key(32, hexes)
    rows = []
    for i in range(400):
        parts = [f"note {i}"]
        if i % 3 == 0:
            parts.append(f"password = {common}")  # a third of all documents hold it
        if i % 13 == 0:
            parts.append(f'API_KEY: "{own[i % 30]}"')
        if i % 17 == 0:
            parts.append(f"seen {own[i % 30]} bare")
        if i % 5 == 0:
            parts.append(f"id {placeholder}")
        if i % 40 == 0:
            parts.append("secret=short token: changeme-changeme AKIA" + key(17, mixed[:26]))
        rows.append((i, " ".join(parts), "en", None if i % 7 == 0 else f"s{i % 4}", 1))
    return rows + rows[:3] + [(900, "", "en", "a", 0), (901, None, None, None, None), (902, "x" * 30000 + " " + common, "en", "s1", 1)]


def plain(text):
    base = []
    for m in re.finditer(r"(?ai:password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m.group(1)) >= 6:
            base.append((m.start(), 0, m.end(), m.start(1)))
    base += [(m.start(), 1, m.end(), m.start()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    base += [(m.start(), 2, m.end(), m.start()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(base)


def test_ownership_against_brute_force(spark):
    rows = table_rows()
    places, texts_of, least = {}, defaultdict(set), {}
    for i, text, _, source, _ in rows:
        text = text or ""
        base = plain(text)
        values = {(v, e) for _, _, e, v in base}
        values |= {m.span() for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text) if not any(s <= m.start() and m.end() <= e for s, _, e, _ in base)}
        places[i] = (base, sorted((a, e) for a, e in values if e - a >= 16 and secrets.credential_like(text[a:e])))
        for a, e in places[i][1]:
            texts_of[text[a:e]].add(text)
        least[text] = min(least.get(text, (True, "~")), (source is not None, source or ""))
    owners = {v: {least[t] for t in ts} for v, ts in texts_of.items()}
    got = secrets.find_secrets(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    seen_live, seen_example = 0, 0
    for r in got:
        text = next(t for i, t, *_ in rows if i == r.doc_id) or ""
        base, values = places[r.doc_id]
        lives = [(a, e) for a, e in values if len(texts_of[text[a:e]]) <= 9 or len(owners[text[a:e]]) <= 2]
        name = lambda k: ("assign", "access", "hex", "owned")[k]
        digest = ",".join(f"{name(k)}:{s}:{e}" for s, k, e, _ in base)
        spans = ",".join(f"{name(k)}:{s}:{e}" for s, k, e in sorted([(s, k, e) for s, k, e, _ in base] + [(a, 3, e) for a, e in lives]))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _, _ in base) for x in range(3))
        assert (r.base_sha256, r.spans, r.n_live, r.n_example) == (hashlib.sha256(digest.encode()).hexdigest(), spans, len(lives), len(values) - len(lives))
        seen_live, seen_example = seen_live + len(lives), seen_example + len(values) - len(lives)
    assert seen_live > 20 and seen_example > 100
