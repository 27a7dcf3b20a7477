import base64
import random

from helpers import ODD_TEXTS, docs, prose

from tallow.llm import compression_bands as C


def brute_repeats(words):
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    return len({j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)})


def test_base_metrics_against_brute_force():
    r = random.Random(1)
    for _ in range(200):
        text = "".join(r.choice("ab #|\n\t é") for _ in range(r.randint(0, 120)))
        n, chars, symbols, dup, repeats = C.base_metrics(text)
        words = [w for w in text.replace("\n", " ").replace("\t", " ").split(" ") if w]
        assert n == len(words) and chars == sum(map(len, words)) and symbols == text.count("#") + text.count("|")
        seen, expected = set(), 0
        for line in text.split("\n"):
            if line.strip(" \t"):
                expected += line in seen
                seen.add(line)
        assert dup == expected and repeats == brute_repeats(words)


def test_bands_reject_noise_and_repetition_and_keep_prose():
    noise = base64.b64encode(random.Random(2).randbytes(9000)).decode()
    spaced = " ".join(noise[i:i + 9] for i in range(0, len(noise), 9))
    assert C.judge(spaced)[-1] == "incompressible"
    assert C.judge("\n".join(f"row {i} of the same old table" for i in range(2000)))[-1] in ("base", "repetitive")
    verdicts = [C.judge(prose(i, n)) for i, n in enumerate((60, 200, 900))]
    assert C.judge(prose(1, 30))[5]  # fewer than 50 words
    assert all(v[-1] in ("ok", "repetitive") for v in verdicts)


def test_limits_depend_on_length():
    assert C.band_verdict(300, 0.31, []) == ("repetitive", 0.0)
    assert C.band_verdict(9000, 0.31, [0.31, 0.31]) == ("ok", 0.0)
    assert C.band_verdict(9000, 0.4, [0.01, 0.5])[0] == "chunks"


def test_odd_rows_extra_columns_and_empty_table(spark):
    d = docs(spark, [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, prose(3, 80)), (1, ""), (1, "")])
    d = d.withColumnRenamed("lang", "kept").withColumnRenamed("source", "n_words")  # clashing names
    out = {tuple(r)[:2] for r in C.quality_report(d).collect()}
    assert len(C.quality_report(d).collect()) == d.count() and (0, 0) in out
    kept = C.keep_quality(d)
    assert kept.columns == d.columns and kept.schema == d.schema
    assert C.quality_report(d.limit(0)).count() == 0


def varied(seed, n):
    """``n`` bytes that compress like prose."""
    r = random.Random(seed)
    return " ".join("".join(r.choices("etaoinshrdlu", (12, 9, 8, 8, 7, 7, 6, 6, 6, 4, 4, 3), k=r.randint(2, 8))) for _ in range(n))[:n]


def test_a_repetitive_rest_counts():
    text = varied(3, 4096) + "congratulations subscribers everywhere " * 100
    verdict = C.judge(text[:7696])
    assert C.WHOLE[-1].low < verdict[7] and verdict[8] < 0.1 and verdict[-1] == "chunks"
    assert C.judge(varied(4, 7696))[-1] == "ok"
    for size in (4096, 4097, 4351, 4352, 8191, 8192, 12000):
        cuts = C.chunk_bounds(size)
        assert cuts[0] == 0 and cuts[-1] == size and min(b - a for a, b in zip(cuts, cuts[1:], strict=False)) >= 256


def test_a_base64_chunk_is_out_of_band():
    blob = base64.b64encode(random.Random(5).randbytes(4096)).decode()
    for text in (varied(6, 4096) + blob[:4096] + varied(7, 4158), varied(8, 4096) + blob[:4000]):
        verdict = C.judge(text)
        assert verdict[7] <= C.WHOLE[-1].high and 0.65 < verdict[9] and verdict[-1] == "chunks"
