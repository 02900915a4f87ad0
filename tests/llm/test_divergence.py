"""Source divergence against plain Python, and the bands against all pairs of terms."""

import random
import re
from collections import Counter, defaultdict

import pandas as pd
import pytest

from llm_fixtures import documents  # noqa: F401
from tickloom.llm import divergence
from tickloom.llm.divergence import divergence_audit, skybands

PATTERN = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top=50, smoothing=5):
    """(lang, source, part, item, value, rank) by the definitions."""
    docs_of, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = PATTERN.findall((text or "").translate(LOWER))
        counts[lang, source].update(words)
        docs_of[lang].update(set(words))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs_of[lang].items() if n >= least]
        own = [s for one, s in groups if one == lang]
        n = {s: sum(counts[lang, s][t] for t in kept) for s in own}
        whole = {t: sum(counts[lang, s][t] for s in own) for t in kept}

        def share(count, total):
            return 1 + 10**9 * (count + smoothing) // (total + smoothing * len(kept))

        def of(s):
            return {t: share(counts[lang, s][t], n[s]) for t in kept}

        p = of(source)
        pairs = []
        for other in own:
            if other != source:
                q = of(other)
                pairs.append((sum(abs(p[t] - q[t]) for t in kept), other))
        terms = [(p[t] - share(whole[t], sum(n.values())), t) for t in kept if counts[lang, source][t]]
        for part, found, last in (("pair", pairs, None), ("term", [x for x in terms if x[0] > 0], top)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, f, i + 1) for i, (f, item) in enumerate(found[:last])]
    return sorted(out)


def made(n, seed):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "gaMMa", "straße", "ÉTÉ", "été", "日本", "zeta9eta", "-"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for _ in range(n):
        source = rng.choice(["s1", "s1", "s1", "s2", "s3", None, ""])
        picked = rng.choices(words, k=rng.randint(0, 30))
        rows.append((" ".join(picked) or None, rng.choice(["en", "en", None]), source))
    return rows + [("word " * 30_000 + "alpha", "en", "s2"), ("", "xx", "s1"), ("only here", "xx", "s2"), ("x", "yy", "s1")]


def audited(spark, rows, **options):
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    return sorted(tuple(r) for r in divergence_audit(df, **options).collect())


@pytest.mark.parametrize("least,top", [(1, 50), (5, 3), (10_000, 50)])
def test_shares_and_ranks_are_those_of_plain_python(spark, least, top):
    rows = made(150, 1)
    assert audited(spark, rows, least_docs=least, top=top) == plain(rows, least, top)


def test_blocks_of_terms_and_sources_and_early_flushes_change_nothing(spark, monkeypatch):
    rows = made(120, 2)
    for name in ("BLOCK_TERMS", "BLOCK_SOURCES", "CHUNK"):
        monkeypatch.setattr(divergence, name, 2)
    assert audited(spark, rows, least_docs=2, top=4) == plain(rows, 2, 4)


def test_tallies_merge_whatever_the_room(monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en", "en", "de"]), pa.array(["s", "s", "t"]), pa.array([b"a b a", b"a C", b"\xc3\xa9 c"], pa.binary())],
        ["lang", "source", "text"],
    )

    def sums():
        found = Counter()
        for b in divergence._tally(iter([batch])):
            for r in b.to_pylist():
                found[r["lang"], r["source"], r["term"], "count"] += r["count"]
                found[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        return found

    whole = sums()
    assert whole["en", "s", "a", "count"] == 3 and whole["en", "s", "a", "docs"] == 2 and whole["en", "s", "c", "docs"] == 1
    monkeypatch.setattr(divergence, "HELD", 1)
    assert sums() == whole


def test_bands_hold_the_terms_that_fewer_than_k_dominate(spark):
    rng = random.Random(3)
    # Terms of one beginning, so that eight bytes do not tell them apart.
    rows = [("en", s, f"{'same-start' if i % 2 else ''}t{rng.randint(0, 10**6)}", rng.randint(1, 12), rng.randint(12, 60))
            for s in ("a", "b") for i in range(700)]
    rows = list({r[:3]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "lang string, source string, term string, count long, lang_count long").repartition(7)
    got = {tuple(r) for r in skybands(df, 4).collect()}
    want = {
        y for y in rows
        if sum(x[1] == y[1] and x[3] >= y[3] and x[4] <= y[4] and x[2] < y[2] for x in rows) < 4
    }
    assert got == want


def test_empty_tables_and_other_columns(spark, documents):
    assert divergence_audit(documents()).collect() == []
    rows = [(i, "one two", "en", f"s{i % 2}") for i in range(4)]
    clashing = documents(*rows, extra=True)
    for name in ("term", "count", "p", "rank", "value", "item", "part", "docs", "lang_count"):
        clashing = clashing.selectExpr("*", f"'x' AS {name}") if name not in clashing.columns else clashing
    got = divergence_audit(clashing, least_docs=1).collect()
    assert sorted(map(tuple, got)) == plain([r[1:] for r in rows], 1)
    assert pd.DataFrame(got, columns=got[0].__fields__).columns.tolist() == ["lang", "source", "part", "item", "value", "rank"]
