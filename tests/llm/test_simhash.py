"""Fingerprints against plain XXH64 counts of word shingles."""

from __future__ import annotations

import re

import numpy as np
import xxhash

from callsheet.llm import simhash


def plain(text: str | None) -> str:
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return "0" * 16
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    bits = [2 * sum(h >> b & 1 for h in hashes) > len(hashes) for b in range(64)]
    return f"{sum(1 << b for b, on in enumerate(bits) if on):016x}"


def test_fingerprints_and_components_against_plain_counts(spark):
    rng = np.random.default_rng(1)
    words = ["Alpha", "beta", "ÄÖ", "漢字", "x", "of", "THE", "\x85z", "q\x00"]
    texts = [None, "", " \t\n", "one", "One two", "a\x0bb\x0cc", "same " * 50, "long " * 60_000] + [" ".join(rng.choice(words, int(rng.integers(1, 60)))) for _ in range(300)]
    texts += [texts[20], texts[20] + " tail", "  " + (texts[21] or "").upper()]
    rows = [(i, t, "f", 1) for i, t in enumerate(texts)] + [(None, "one", "f", 1), (8, texts[8], "f", 1)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp string, root int")).collect()
    assert len(got) == len(rows)
    want = {i: plain(t) for i, t in enumerate(texts)}
    assert all(r.fingerprint == want[r.doc_id] for r in got if r.doc_id is not None)
    # Components: every pair within three bits, closed over links.
    prints = sorted(set(want.values()))
    label = {p: p for p in prints}
    value = {p: int(p, 16) for p in prints}
    moved = True
    near = [(a, b) for a in prints for b in prints if a < b and (value[a] ^ value[b]).bit_count() <= 3]
    while moved:
        moved = False
        for a, b in near:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    least = {}
    for i, p in want.items():
        least[label[p]] = min(least.get(label[p], i), i)
    assert all(r.component_id == least[label[r.fingerprint]] for r in got)
