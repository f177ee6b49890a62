import random
import re
from collections import Counter

import zstandard

from barograph.llm import compression_rules as c
from barograph.llm import queries


def brute(text):
    words = [m for m in re.findall("[^\\x20\\x09-\\x0D]+", text or "")]
    lines = (text or "").split("\n")
    worded = [x for x in lines if re.search("[^\\x20\\x09-\\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        sum(x in worded[:i] for i, x in enumerate(worded)),
        len(covered),
    )


def test_counts_equal_brute_force(odd, docs):
    texts = [r["text"] for r in odd.collect()] + [r["text"] for r in docs.collect()]
    rng = random.Random(3)
    texts += [" ".join(rng.choice("ab c d\n e") for _ in range(n)) for n in range(60)]
    for text in texts:
        if text is None or len(text) < 60_000:
            assert c.counts((text or "").encode()) == brute(text)


def test_many_distinct_words_take_the_longer_way():
    words = [f"w{i}" for i in range(9000)] + [f"w{i}" for i in range(20, 40)]
    assert c.repeated_words([w.encode() for w in words]) == 40


def test_bands():
    press = zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=False)
    judge = lambda text: c.judged(text, press, c.DEFAULT_BANDS)[-1]
    rng = random.Random(1)
    noise = bytes(rng.randrange(256) for _ in range(8000))
    prose = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(1500))
    assert judge(b"") and judge(prose.encode()) and judge(b"short text")
    assert not judge(noise) and not judge(b"all the same " * 500)
    assert not judge(prose.encode()[:4000] + b"again and again " * 900)


def test_rows_and_verdicts(spark, odd, none, folder):
    rows = c.compression_rules(odd).collect()
    assert len(rows) == odd.count() and c.compression_rules(none).count() == 0
    assert all(r["in_bands"] for r in rows if r["n_words"] == 0)
    found = queries.op5_compression_rules(spark, folder).collect()
    for r in found:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_clean_documents_stay(spark, larger):
    labels = spark.read.parquet(f"{larger}/labels.parquet").where("quality = 1")
    rows = queries.op5_compression_rules(spark, larger).join(labels, "doc_id").where("NOT base_failed")
    assert rows.where("NOT kept").count() <= 0.01 * rows.count()


def test_the_end_of_a_text_is_judged():
    press = zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=False)
    rng = random.Random(5)
    prose = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(900))
    start = prose.encode()[:2048]
    noise = bytes(rng.randrange(256) for _ in range(1000))
    whole, least, _, chunks, outside, _ = c.judged(start + noise, press, c.DEFAULT_BANDS)
    assert chunks == 2 and least == min(len(p) / len(press.compress(p)) for p in (start, (start + noise)[-2048:]))
    assert c.judged(start * 2, press, c.DEFAULT_BANDS)[3] == 2
    assert c.judged(start[:2000], press, c.DEFAULT_BANDS)[3] == 0
    _, _, most, _, outside, fine = c.judged(start + b"again " * 170, press, c.DEFAULT_BANDS)
    assert most > c.DEFAULT_BANDS.chunk.most and outside == 1 and not fine


def test_verdicts_equal_plain_bands(spark, docs, folder):
    def verdict(text):
        data = (text or "").encode()
        if not data:
            return True

        def ratio(part):
            return len(part) / len(zstandard.ZstdCompressor(level=3, write_content_size=False).compress(part))

        limits = [(200, 0.0, 2.5), (1000, 1.1, 2.7), (4000, 1.3, 3.2), (16_000, 1.4, 3.8), (10**12, 1.5, 4.5)]
        least, most = next((a, b) for upto, a, b in limits if len(data) <= upto)
        chunks = [data[i : i + 2048] for i in range(0, len(data), 2048) if i + 2048 <= len(data)]
        if chunks and len(data) % 2048:
            chunks.append(data[len(data) - 2048 :])
        outside = [not 1.3 <= ratio(x) <= 3.2 for x in chunks]
        return least <= ratio(data) <= most and 4 * sum(outside) <= len(outside)

    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = queries.op5_compression_rules(spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        n, _, _, _, repeats = brute(texts[r["doc_id"]])
        failed = n < 10 or 100 * repeats > 20 * n
        assert r["kept"] == (not failed and verdict(texts[r["doc_id"]]))
    assert {r["kept"] for r in found} == {True, False}
