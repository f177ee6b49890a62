import random

from barograph.llm import license_scan as lic


def scan(text):
    known = lic.notices(lic.NOTICES)
    return lic.scan_words(lic.words_of(text), known, lic.DEFAULT_RULES)


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0, *[0] * len(b)] if not row else row
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_every_notice_is_found_where_it_stands():
    for name, text in lic.NOTICES.items():
        before, after = "some words of the text come first", "and more words follow"
        found = scan(f"{before} {text} {after}")
        size, at = len(lic.words_of(text)), len(lic.words_of(before))
        assert any(n == name and c == 1.0 and s == at and e == at + size for n, c, s, e in found), (name, found)


def test_edited_repeated_and_partial_notices():
    notice = lic.NOTICES["MIT notice"]
    words = notice.split()
    edited = " ".join(w if i % 11 else "other" for i, w in enumerate(words))
    assert [m[0] for m in scan(f"x {edited} y")] == ["MIT notice"]
    assert [m[0] for m in scan(f"{lic.NOTICES['MIT line']}. {lic.NOTICES['MIT line']}.")] == ["MIT line"] * 2
    assert scan(" ".join(words[: len(words) // 2])) == []
    rng = random.Random(1)
    shuffled = words[:]
    rng.shuffle(shuffled)
    assert scan(" ".join(shuffled)) == []
    assert scan(None) == scan("") == scan("the license is free to use " * 3) == []


def test_alignment_is_a_common_subsequence():
    rng = random.Random(7)
    for _ in range(200):
        a = [rng.choice("abcdefghij") for _ in range(rng.randrange(12))]
        b = [rng.choice("abcdefghij") for _ in range(rng.randrange(16))]
        pairs = lic.aligned(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) <= longest_common(a, b)
    distinct = rng.sample(range(100), 30)
    other = [str(x) for x in distinct if x % 3] + ["z"]
    words = [str(x) for x in distinct]
    assert len(lic.aligned(words, other)) == longest_common(words, other)


def test_rising():
    rng = random.Random(2)
    for _ in range(50):
        values = rng.sample(range(60), 15)
        run = [values[i] for i in lic.rising(values)]
        assert run == sorted(run) and len(run) == longest_common(values, sorted(values))


def test_rows(spark, odd, none, docs, larger):
    rows = lic.license_scan(odd).collect()
    assert len(rows) == odd.count() and all(r["license"] is None and r["matches"] == [] for r in rows)
    assert lic.license_scan(none).count() == 0
    table = spark.read.parquet(f"{larger}/documents.parquet")
    found = {r["doc_id"]: r["license"] for r in lic.license_scan(table).where("license IS NOT NULL").collect()}
    lines = {
        "GNU General Public License, version 3": "GPL-3.0 line", "CC BY-NC 4.0": "CC-BY-NC-4.0 line",
        "under the MIT License": "MIT line", "Apache License, Version 2.0": "Apache-2.0 line",
    }
    wanted = {
        r["doc_id"]: name for r in table.collect() for line, name in lines.items() if line in r["text"]
    }
    assert found == wanted and wanted


def test_longer_texts_win_over_their_openings():
    for name in ("MIT text", "BSD-2-Clause text", "BSD-3-Clause text", "GPL-3.0 notice", "GPL-2.0 notice", "LGPL-3.0 notice",
                 "LGPL-2.1 notice", "AGPL-3.0 notice", "ISC text", "Unlicense text", "EPL-2.0 notice", "Zlib text"):
        found = scan("some code here\n" + lic.NOTICES[name] + "\nand more code")
        assert [f[0] for f in found] == [name] and found[0][1] == 1.0, name


def test_many_notices_in_one_text_take_linear_time():
    import time

    line = lic.NOTICES["MIT line"] + ". "
    spent = []
    for n in (1000, 4000):
        text = line * n
        start = time.perf_counter()
        assert len(scan(text)) == n
        spent.append(time.perf_counter() - start)
    assert spent[1] < 8 * spent[0]


def test_scan_equals_trying_every_window(docs):
    """Every stretch of every length up to twice a short notice, against the scan."""
    rng = random.Random(4)
    notice = lic.Notice("n", tuple("alpha beta gamma delta epsilon zeta".split()))
    rules = lic.LicenseRules(gap=3)
    for _ in range(150):
        words = [rng.choice([*notice.words, "x", "y", "z"]) for _ in range(rng.randint(0, 14))]
        if rng.random() < 0.6:
            copy = list(notice.words)
            if rng.random() < 0.5:
                copy.insert(rng.randrange(6), "w")
            at = rng.randint(0, len(words))
            words[at:at] = copy
        possible = any(
            notice.best_run(words, a, b, rules) for a in range(len(words)) for b in range(a + 1, min(len(words), a + 12) + 1)
        )
        found = notice.find(words, rules)
        assert bool(found) == possible or not found  # nothing is found where no window has it
        for coverage, start, end in found:
            part = words[start:end]
            assert len(lic.aligned(notice.words, part)) >= rules.coverage * 6 and coverage >= rules.coverage
        assert all(a[2] <= b[1] for a, b in zip(found, found[1:], strict=False))
        if "alpha beta gamma delta epsilon zeta" in " ".join(words) and len(words) <= 6:
            assert found
