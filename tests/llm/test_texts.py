"""Token counts, packing, media, sketches and scores."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemart.llm import media, packing, quality, queries, sketch, toxicity
from tidemart.llm.token_count import PieceCounter, count_tokens

ODD = ["", " ", "\n", "  a  b \n c", "<s>hi</s><unk>", "▁x", "日本語 текст 😀", "<0x0A>", "a" * 3000, "x\x00y", "<|endoftext|> a<|endoftext|>", "１２ ﬁ é e\u0301", "a\u00a0b\u2003c", "don't we'LL 's"]
DOCS = "doc_id long, text string, n_tokens int, media string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    path = queries.tokenizer_path("piece_bpe_32k.model")
    return PieceCounter(path), sentencepiece.SentencePieceProcessor(model_file=path)


def test_counts_are_the_librarys(pieces, spark, sf_dir):
    count, lib = pieces
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    assert [count(t) for t in texts] == [len(x) for x in lib.encode(texts)]


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=60))
def test_counts_of_any_text(pieces, text):
    count, lib = pieces
    text = text.encode("utf-8", "ignore").decode()
    assert count(text) == len(lib.encode(text))


def test_count_rows(spark):
    df = frame(spark, [None, "", "a b", "a b", "hello " * 5000])
    rows = sorted(count_tokens(df, queries.tokenizer_path("piece_bpe_32k.model")).collect())
    assert [(r.n_bytes, r.n_tokens) for r in rows[:2]] == [(0, 0), (0, 0)] and rows[2][1:] == rows[3][1:]
    assert rows[4].over_limit and not rows[3].over_limit
    assert count_tokens(df.limit(0), queries.tokenizer_path("piece_bpe_32k.model")).count() == 0


@pytest.fixture(scope="module")
def ids():
    return packing.Ids(*queries.byte_bpe())


def test_ids_are_the_tokenizers(ids, spark, sf_dir):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60).collect()]
    assert [ids(t) for t in texts] == [ids.exact.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("blank", [" ", "\n", " \r\n\t"])
def test_ids_of_long_whitespace(ids, blank):
    text = "a b" + blank * (1_200_000 // len(blank)) + "c d"
    assert ids(text) == ids.exact.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]) | st.sampled_from("Ωλ\u0378Жяё\u0483あンヴ\u3099ー漢字\u4e00\u9fa5가힣 1'"), max_size=50))
def test_ids_of_any_text(ids, text):
    assert ids(text) == ids.exact.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("n", "want"), [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (16, [(0, 8), (8, 8)]), (19, [(0, 3), (3, 8), (11, 8)])])
def test_cut(n, want):
    assert packing.cut(n, 8) == want


@settings(max_examples=60, deadline=None)
@given(lengths=st.lists(st.integers(1, 40), max_size=120))
def test_bins_are_gapless_and_few(lengths):
    bins, offsets = packing.sum_of_squares(np.array(lengths, np.int64), 40)
    held = defaultdict(list)
    for b, o, n in zip(bins, offsets, lengths, strict=True):
        held[b].append((o, n))
    for places in held.values():
        end = 0
        for o, n in sorted(places):
            assert o == end
            end += n
        assert end <= 40
    assert len(held) <= 2 * -(-sum(lengths) // 40) + 1


def slow_sum_of_squares(lengths, capacity):
    """The rule spelled out: try every open bin, take the one with the least sum (then the tightest)."""
    gaps = []
    for s in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= s]
        if not fits:
            gaps.append(capacity - s)
            continue

        def after(g):
            rest = list(gaps)
            rest.remove(g)
            counts = defaultdict(int)
            for x in [*rest, g - s]:
                if x:
                    counts[x] += 1
            return sum(v * v for v in counts.values()), g

        g = min(set(fits), key=after)
        gaps.remove(g)
        gaps.append(g - s)
    return sorted(gaps)


@settings(max_examples=60, deadline=None)
@given(lengths=st.lists(st.integers(1, 20), max_size=40))
def test_packing_follows_the_rule(lengths):
    bins, offsets = packing.sum_of_squares(np.array(lengths, np.int64), 20)
    fill = defaultdict(int)
    for b, n in zip(bins, lengths, strict=True):
        fill[b] += n
    assert sorted(20 - f for f in fill.values()) == slow_sum_of_squares(lengths, 20)


def test_pack_rows(spark, ids):
    texts = [None, "", "a", "a", "hello world " * 2000, *[f"word {i} " * (i % 50) for i in range(150)]]
    df = frame(spark, texts).union(frame(spark, ["twice"])).union(frame(spark, ["twice"]))
    rows = packing.pack(df, queries.byte_bpe(), shard_items=60).collect()
    byseq, bydoc = defaultdict(list), defaultdict(list)
    for r in rows:
        byseq[r.sequence_id].append((r.offset, r.length))
        if r.doc_id > 0:
            bydoc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for places in byseq.values():
        end = 0
        for o, n in sorted(places):
            assert o == end
            end += n
        assert end <= 2048
    for d, found in bydoc.items():
        want = np.array([*ids(texts[d] or ""), 0], "<u4")
        assert sum(n for _, _, n, _ in found) == len(want)
        for k, (piece, start, n, crc) in enumerate(sorted(found)):
            assert piece == k and zlib.crc32(want[start : start + n].tobytes()) == crc and (n == 2048 or k == 0)
    assert sum(r.doc_id == 0 for r in rows) == 3
    total = sum(r.length for r in rows)
    assert len(byseq) <= -(-total // 2048) + 3
    assert packing.pack(df.limit(0), queries.byte_bpe()).count() == 0


def test_repeated_rows_spread_over_shards(spark):
    df = spark.createDataFrame([(None, "the same words")] * 600, "doc_id long, text string").repartition(3)
    rows = packing.pack(df, queries.byte_bpe(), shard_items=60).collect()
    shards = defaultdict(int)
    for r in rows:
        shards[r.sequence_id >> 40] += 1
    assert len(rows) == 600 and len(shards) == 10 and max(shards.values()) < 120
    assert len({(r.sequence_id, r.offset) for r in rows}) == 600


def test_media(spark):
    texts = [None, "", "x" * 63, "x" * 64, "x" * 65, "é" * 100, "abc def " * 40_000, "twice", "twice"]
    rows = sorted(media.wav_features(media.to_wav(frame(spark, texts))).collect())
    for r, t in zip(rows, texts, strict=True):
        raw = (t or "").encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-64:]) and r.media_bytes == len(media.wav_bytes(payload))
        assert list(r.fp_times) == sorted(r.fp_times) and len(r.fp_times) == len(r.fp_hashes)
    assert rows[7][2:] == rows[8][2:]
    stored = media.media_features(frame(spark, texts).union(spark.createDataFrame([(None, "x", 0, "y")], DOCS)))
    assert sorted(r.payload_sha256 for r in stored.collect()) == sorted([*(r.payload_sha256 for r in rows), hashlib.sha256(b"x" + bytes(63)).hexdigest()])
    assert {"fp_times", "fp_hashes", "feature"} <= set(stored.columns)
    assert media.to_wav(frame(spark, []).limit(0)).count() == 0


def test_fingerprints_like_a_naive_transform():
    data = np.random.default_rng(5).integers(0, 256, 3000, np.uint8)
    n = -(-(len(data) - media.FRAME) // media.HOP) + 1
    x = np.zeros((n - 1) * media.HOP + media.FRAME)
    x[: len(data)] = data.astype(float) - 128
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(media.FRAME) / (media.FRAME - 1))
    turn = np.exp(-2j * np.pi * np.outer(np.arange(media.FRAME // 2 + 1), np.arange(media.FRAME)) / media.FRAME)
    power = np.array([np.abs(turn @ (x[i * media.HOP : i * media.HOP + media.FRAME] * window)) for i in range(n)])
    peaks = []
    for t in range(0, n, media.SLAB):
        for low, high in media.BANDS:
            tile = power[t : t + media.SLAB, low:high]
            a, b = np.unravel_index(tile.argmax(), tile.shape)
            peaks.append((t + a, low + b))
    peaks.sort()
    times, bins = media.spectral_peaks(data)
    assert list(zip(times, bins, strict=True)) == peaks
    pairs = sorted((t, b << 16 | c << 8 | u - t) for k, (t, b) in enumerate(peaks) for u, c in peaks[k + 1 : k + 1 + media.FAN_OUT] if u - t <= media.ZONE)
    assert list(zip(*media.pair_fingerprints(times, bins), strict=True)) == pairs


def test_peaks_find_a_tone():
    t = np.arange(8000)
    tone = (128 + 100 * np.sin(2 * np.pi * t * 30 / media.FRAME)).astype(np.uint8)
    times, bins = media.spectral_peaks(tone)
    assert (bins == 30).sum() >= len(set(times // media.SLAB)) - 1
    a, b = media.pair_fingerprints(times, bins)
    assert len(a) and (b & 0xFF).max() <= media.ZONE


def test_blocks_of_frames_do_not_show(monkeypatch):
    data = np.random.default_rng(0).integers(0, 256, 60_000, np.uint8)
    whole = media.spectral_peaks(data)
    monkeypatch.setattr(media, "BLOCK", 64)
    assert all((a == b).all() for a, b in zip(whole, media.spectral_peaks(data), strict=True))


def brute_sketch(text):
    w = [x for x in __import__("re").split("[ \t\n\r\f]+", text) if x]
    h = {hashlib.md5(" ".join(w[i : i + 5]).encode()).hexdigest()[:12] for i in range(max(1, len(w) - 4))} if w else set()
    return min(h, default=None), sorted(x for x in h if int(x, 16) < 16**12 / 8)


def shown(sketch_):
    return (sketch_[0] or "") + "|" + " ".join(sketch_[1])


def like(x, y):
    a, b = set(x[1]), set(y[1])
    return len(a & b) / len(a | b) if a | b else float(x[0] == y[0])


def test_sketches_like_brute_force(spark):
    texts = {9: "a b c d e f g", 8: None, 7: "", 5: "z", 4: " ".join(f"w{i}" for i in range(400)), 2: "a b c d e f g", 1: "é" * 10, 0: "word " * 200_000, None: "null id"}
    rows = spark.createDataFrame([(k, v, "x") for k, v in texts.items()], "doc_id long, text string, next string")
    for buckets in (1, 3, 8):
        out = {r.doc_id: r for r in sketch.fingerprints(rows, buckets=buckets).collect()}
        order = sorted((k for k in texts if k is not None), reverse=True) + [None]
        for k, following in zip(order, order[1:] + order[:1], strict=True):
            own, nxt = texts[k] or "", texts[following] or ""
            n = len(own)
            changed = own[: n - n // 3] + nxt[: n // 3]
            a, b, c = brute_sketch(own), brute_sketch(changed), brute_sketch(nxt)
            r = out[k]
            assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(changed.encode()).hexdigest())
            assert (r.fingerprint, r.edited_fingerprint, r.kept_hashes) == (shown(a), shown(b), len(a[1]))
            assert (r.near_edited, r.near_next) == (like(a, b), like(a, c))
            both = {*a[1], *c[1]}
            assert r.edited_in_both == (1.0 if b[0] is None else sum(x in both for x in b[1]) / len(b[1]) if b[1] else None)
    assert sketch.fingerprints(rows.limit(0)).count() == 0
    assert sketch.fingerprints(rows.limit(1)).count() == 1
    twice = sketch.fingerprints(rows.union(rows), buckets=3)
    assert twice.count() == 2 * len(texts)


def test_neighbours_of_hot_ids(spark):
    rows = [(None, f"null {i}") for i in range(60)] + [(7, f"seven {i}") for i in range(80)] + [(i, f"t{i}") for i in range(100, 140)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for buckets in (1, 5, 24):
        out = sketch.with_next(df, "doc_id", ["text"], buckets).collect()
        following = {r.text: r["next"]["text"] for r in out}
        assert len(out) == len(rows) and len(following) == len(rows)
        at, order = "t139", []
        for _ in rows:  # one circle through all rows, ids descending
            order.append(at)
            at = following[at]
        ids = {t: i for i, t in rows}
        seen = [ids[t] for t in order]
        assert at == "t139" and len(set(order)) == len(rows)
        assert seen == sorted((i for i in seen if i is not None), reverse=True) + [None] * 60


def test_neighbours_through_levels_of_cuts(spark, monkeypatch):
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("doc_id"), F.col("id").alias("n"))
    plans = []
    for fan, buckets in ((2, 40), (3, 81), (128, 2), (128, 100)):
        monkeypatch.setattr(sketch, "FAN", fan)
        out = sketch.with_next(df, "doc_id", ["doc_id"], buckets)
        assert {(r.doc_id, r["next"]["doc_id"]) for r in out.select("doc_id", "next").collect()} == {(i, (i - 1) % 500) for i in range(500)}
        plans.append(len(out._jdf.queryExecution().optimizedPlan().toString()))
    assert abs(plans[3] - plans[2]) < 100  # no literal for a bucket


def test_containment_and_union_of_unequal_texts(spark):
    long = [f"w{i}" for i in range(3000)]
    texts = {"long": long, "part": long[:1000], "short": long[10:16], "other": [f"x{i}" for i in range(900)], "none": []}
    df = spark.createDataFrame([tuple(" ".join(t) for t in texts.values())], ", ".join(f"{n} string" for n in texts))
    s = {n: sketch.sketch(F.col(n)) for n in texts}
    got = df.select(
        sketch.containment(s["part"], s["long"]).alias("part"),
        sketch.containment(s["none"], s["long"]).alias("none"),
        sketch.containment(s["short"], s["long"]).alias("short"),
        sketch.containment(s["long"], s["part"]).alias("back"),
        sketch.containment(s["other"], s["long"]).alias("other"),
        sketch.united(s["part"], s["other"]).alias("union"),
    ).first()
    assert got.part == got.none == 1.0 and got.other == 0.0 and abs(got.back - 1 / 3) < 0.06
    assert got.short == (1.0 if brute_sketch(" ".join(texts["short"]))[1] else None)
    hashes = [brute_sketch(" ".join(texts[n])) for n in ("part", "other")]
    assert (got.union.least, got.union.kept) == (min(h[0] for h in hashes), sorted({*hashes[0][1], *hashes[1][1]}))


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("1D10T, МОRОN! 2024 c@fé", "idiot moron cafe"),
        ("ＩＤＩＯＴ ïdiot 𝓲𝓭𝓲𝓸𝓽 ıdıot", "idiot idiot idiot idiot"),
        ("id\u200biot i\u00addiot \ufeffidiot !d!ot", "idiot idiot idiot idiot"),
        ("you i.d.i-o_t and m o r o n s", "you idiot and morons"),
        ("hi! a b, 3.14 of 10", "hi a b of"),
        (None, ""),
    ],
)
def test_folding(text, want):
    assert toxicity.fold(text).strip() == want


def test_lexicon_hits():
    lex = toxicity.Lexicon({"idiot": 4.0, "trash": 3.0, "tras": 1.0})
    assert lex.hits("What an 1d10t, idiots!")[0] == 8.0
    assert lex.hits("put it in the trash can")[0] == 0.0 and lex.hits("trash")[0] == 3.0
    assert lex.hits("hidiot")[0] == 0.0 and lex.hits("")[0] == 0.0 and lex.hits(None) == (0.0, 0)


@settings(max_examples=200, deadline=None)
@given(entries=st.sets(st.text("abc", min_size=1, max_size=4), max_size=6), phrases=st.sets(st.sampled_from(["a b", "ab c", "b", "cab ab"]), max_size=3), text=st.text("abcA1 .", max_size=40))
def test_hits_like_naive_matching(entries, phrases, text):
    lex = toxicity.Lexicon({e: float(i + 1) for i, e in enumerate(sorted(entries))}, exceptions=tuple(phrases))
    plain = toxicity.fold(text)
    words = [i + 1 for i, c in enumerate(plain[:-1]) if c == " " and plain[i + 1] != " "]
    spots = {w: max((e for e in entries if plain.startswith(e, w)), key=len, default=None) for w in words}
    excused = [(i, i + len(p) + 1) for p in phrases for i in range(len(plain)) if plain.startswith(f" {p} ", i)]
    want = sum(lex.weights[e] for w, e in spots.items() if e and not any(a <= w - 1 < b for a, b in excused))
    assert lex.hits(text) == (want, len(words))


def test_learned_entries_and_exceptions(spark):
    plain = lambda i: " ".join(f"p{(i * 7 + j) % 89} text" for j in range(20))
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        extra = "you grobling" if bad and i % 2 else "such extraordinarilywickedness" if bad and i % 4 == 0 else "a grobling stone" if i % 60 == 1 else ""
        rows.append((i, f"{plain(i)} {extra} {plain(i + 1)}" if not (bad and not extra) else f"{plain(i)} rarest{i}"))
        labels.append((i, int(bad)))
    rows += [(1000 + k, "one text that was copied with onlyhere in it") for k in range(30)]
    labels += [(1000 + k, 1) for k in range(30)]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    lex = toxicity.learn(docs, known)
    assert any("grobling".startswith(e) for e in lex.weights) and any("extraordinarilywickedness".startswith(e) for e in lex.weights)
    assert "grobling stone" in lex.exceptions and lex.score("a grobling stone") < lex.score("you grobling")
    assert not any("onlyhere".startswith(e) for e in lex.weights)  # copies of one row are one use
    assert lex.score("you grobling") > 0.5 > lex.score(plain(3))


def test_no_bound_on_entries(spark):
    """Thousands of entries, each too telling to be chance, all stay."""
    rows = [(i, " ".join(f"bad{a}" for a in ("".join(chr(97 + (k // 26**j) % 26) for j in range(4)) + "x" for k in range((i // 2) % 2 * 3000, (i // 2) % 2 * 3000 + 3000))) if i % 2 else f"good {i}") for i in range(400)]
    shuffled = [(i, " ".join(sorted(t.split(), key=lambda w, i=i: hashlib.md5(f"{w}{i}".encode()).digest()))) for i, t in rows]
    docs = spark.createDataFrame(shuffled, "doc_id long, text string")
    lex = toxicity.learn(docs, spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int"))
    assert all(lex.hits("bad" + "".join(chr(97 + (k // 26**j) % 26) for j in range(4)) + "x")[0] > 0 for k in range(0, 6000, 97))


def labelled(spark, n=400):
    rows, labels = [], []
    for i in range(n):
        bad, low = i % 5 == 0, i % 4 == 0
        text = " ".join(f"plain{(i * 7 + j) % 97} text" for j in range(30)) + (" you gr0ssling" if bad else "") + (" $$$ %%% &&&" * 20 if low else "")
        rows.append((i, text))
        labels.append((i, int(not low), int(bad)))
    rows += [(n, None), (n + 1, ""), (n + 2, rows[0][1]), (n + 2, rows[0][1])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(("op", "label", "folds", "fold"), [(toxicity, "toxic", 5, 0), (quality, "quality", 3, 1)])
def test_scores(spark, op, label, folds, fold):
    docs, labels = labelled(spark)
    model = op.learn(docs, labels)
    out = op.scored(docs, model)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == docs.count()
    held = {r.doc_id: r.held_out for r in out.collect()}
    assert all(h == (zlib.crc32(str(d).encode()) % folds == fold) for d, h in held.items())
    right = out.where("held_out").join(labels, "doc_id").where(F.col("predicted") == F.col(label)).count()
    assert right / out.where("held_out").join(labels, "doc_id").count() >= 0.95
    empty = [r.score for r in out.where(f"doc_id in (400, 401)").collect()]
    assert len(empty) == 2 and empty[0] == empty[1] and 0 <= empty[0] <= 1
    assert op.scored(docs.limit(0), model).count() == 0
    kept = toxicity.harmless(docs, model) if op is toxicity else quality.worthy(docs, model)
    assert kept.columns == docs.columns


@pytest.mark.parametrize("op", [toxicity, quality])
def test_scores_without_labels(spark, op):
    docs, labels = labelled(spark, 40)
    for some in (labels.limit(0), labels.where("toxic = 0 and quality = 1")):
        out = op.scored(docs, op.learn(docs, some))
        assert out.where("score < 0 or score > 1").count() == 0


def test_chunks_cover_the_text():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        found = quality.chunks_of("a" * n)
        assert found.shape[2] == quality.WIDTH and found.shape[1] == max(1, -(-max(0, n - quality.WIDTH) // quality.STEP) + 1)
        assert (found[0] == 97).any(axis=1).all() == (n > 0)


@pytest.mark.parametrize("marks", [True, False])
@pytest.mark.parametrize("text", ["", "a", "abc " * 300, "é日" * 500])
def test_scores_like_naive_convolution(text, marks):
    net = quality.Network.fresh(5, marks)
    raw = text.encode()
    repeats = [int(marks and any(i - lag - quality.RUN + 1 >= 0 and raw[i - quality.RUN + 1 : i + 1] == raw[i - lag - quality.RUN + 1 : i - lag + 1] for lag in range(2, quality.LAGS + 1))) for i in range(len(raw))]
    tops, at = [], 0
    while not tops or at - quality.STEP + quality.WIDTH < len(raw):
        part = raw[at : at + quality.WIDTH].ljust(quality.WIDTH, b"\0")
        mark = (repeats[at : at + quality.WIDTH] + [0] * quality.WIDTH)[: quality.WIDTH]
        planes = np.array([[*net.embed[b], m] for b, m in zip(part, mark, strict=True)])
        spots = [planes[i : i + quality.TAPS].ravel() @ net.filters + net.bias for i in range(0, quality.WIDTH - quality.TAPS + 1, quality.STRIDE)]
        tops.append(np.maximum(np.max(spots, axis=0), 0))
        at += quality.STEP
    z = np.concatenate([np.mean(tops, axis=0), np.max(tops, axis=0)]) @ net.head + net.constant[0]
    assert net.score(text) == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)


def test_long_rows_do_not_use_up_the_sample(spark):
    docs = spark.createDataFrame([(i, "x" * (quality.SAMPLE_CHARS + 1) if i % 4 else f"text {i}") for i in range(80)] + [(None, "n")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 8 // 4) for i in range(80)] + [(None, 1)], "doc_id long, quality int")
    some = toxicity.training_rows(docs, labels, "quality", 3, 1, 5, "doc_id", "text", quality.SAMPLE_CHARS).collect()
    assert sorted(r.y for r in some) == [0] * 5 + [1] * 5


def test_network_gradients():
    net = quality.Network.fresh(3)
    chunks = quality.chunks_of("some text here " * 60)
    grads, _ = net.gradients(chunks, 1)
    for w, g in zip(net.weights(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept, step, losses = w[at], 1e-2, []
        for sign in (1, -1):
            w[at] = kept + sign * step
            losses.append(net.gradients(chunks, 1)[1])
        w[at] = kept
        assert (losses[0] - losses[1]) / (2 * step) == pytest.approx(g[at], rel=0.2, abs=1e-3)
