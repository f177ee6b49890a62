import re
from collections import Counter

import pytest

from barograph.llm import source_audit
from barograph.llm.source_audit import AuditRules

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def counted(rows):
    """(kept terms by language, counts by group)."""
    docs, groups = {}, {}
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]
        groups.setdefault((lang, source), Counter()).update(terms)
        docs.setdefault(lang, Counter()).update(set(terms))
    return {lang: sorted(t for t, n in d.items() if n >= 3) for lang, d in docs.items()}, groups


def brute(rows, top=200):
    kept, groups = counted(rows)
    out = []

    def prices(counts, lang):
        whole = sum(counts[t] for t in kept[lang]) + len(kept[lang])
        return {t: 1 + 10**9 * (counts[t] + 1) // whole for t in kept[lang]}

    for (lang, source), counts in groups.items():
        p = prices(counts, lang)
        everything = sum((c for (other, _), c in groups.items() if other == lang), Counter())
        q = prices(everything, lang)
        found = [
            (sum((p[t] - r[t]) ** 2 // r[t] for t in kept[lang]), item)
            for (other, item), c in groups.items()
            if other == lang and item != source
            for r in [prices(c, lang)]
        ]
        terms = [((p[t] - q[t]) ** 2 // q[t], t) for t in kept[lang] if counts[t] and p[t] > q[t]]
        for part, values, most in (("pair", found, None), ("term", terms, top)):
            values.sort(key=lambda v: (-v[0], v[1].encode()))
            out += [(lang, source, part, item, v, k) for k, (v, item) in enumerate(values[:most], 1)]
    return sorted(out)


def audited(docs, rules=source_audit.DEFAULT_RULES):
    rows = source_audit.audit(docs, rules).collect()
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in rows)


def plain(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]


def test_odd_rows(odd, none):
    got = audited(odd)
    assert got == brute(plain(odd))
    assert {r[0] for r in got} >= {"", "en", "de"}
    assert audited(none) == []


def test_given_documents(docs):
    assert audited(docs) == brute(plain(docs))


@pytest.mark.parametrize(
    "rules",
    [
        AuditRules(block_counts=40, columns=16, cells=64, tile=3, held_terms=10),
        AuditRules(block_counts=7, columns=2, cells=2, tile=1, held_terms=1),
    ],
)
def test_small_blocks_and_tiles_give_the_same(docs, rules):
    docs = docs.where("doc_id < 120")
    assert audited(docs, rules) == audited(docs)


def test_one_source_with_most_rows(spark):
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}" for i in range(100)]
    rows = [(i, " ".join(words[i % 90 : i % 90 + 10]) + " The", "en", "hot") for i in range(400)]
    rows += [(i, " ".join(words[i % 50 : i % 50 + 3]) + " the the", "en", f"s{i % 7}") for i in range(60)]
    rows += [(900, None, "en", "silent"), (901, "ein", "de", "x"), (902, None, "de", "y"), (903, "", "fr", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    got = audited(docs)
    assert got == brute(rows)
    assert [r for r in got if r[0] == "de"] == [("de", "x", "pair", "y", 0, 1), ("de", "y", "pair", "x", 0, 1)]


def test_joint_tables(spark, docs):
    docs = docs.na.fill("", ["lang", "source", "text"])
    kept = source_audit.kept_terms(source_audit.term_counts(docs))
    groups = source_audit.groups_of(docs, kept)
    got = {tuple(r)[:5]: r["terms"] for r in source_audit.joint_tables(kept, groups).collect()}
    terms, counts = counted(plain(docs))
    want = Counter()
    for (lang, a), here in counts.items():
        for (other, b), there in counts.items():
            if lang == other and a < b:
                want.update((lang, a, here[t], b, there[t]) for t in terms[lang])
    assert got == want


def test_large_counts_are_priced_in_whole_numbers():
    import numpy as np

    n = np.array([0, 10**12])
    assert source_audit._price(n, 10**13, 5, 10**9).tolist() == [
        1 + 10**9 // (10**13 + 5),
        1 + 10**9 * (10**12 + 1) // (10**13 + 5),
    ]
