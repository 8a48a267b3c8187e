from __future__ import annotations

import hashlib
import itertools
import math
import random
import time

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest

from keytide.llm import blocks, chat, fingerprints, packing, pieces, quality, token_counts, warc

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

STRANGE = [
    "", " ", "   a", "it's we'll  don't\n\n x", "<|endoftext|>", "a  <|endoftext|> b<|endoftext|>", "\xa0 b   c",
    "ﬁ é é İ Σς 中文字 😀👍🏽", "a" * 700, "!?" * 300 + " " * 400, "x\x1c\x1dy\x85z", "▁▁ ▁a", "</s><s><0x0A> 12345",
    "tab\tnew\r\nline", "0123456789" * 40, "ÀÉÎ" * 200, "​‍", "<|startoftext|>Hi<|endoftext|>",
]


def strange(spark):
    return spark.createDataFrame([*enumerate(STRANGE), (None, None)], "doc_id long, text string").repartition(3)


# --- token counts --------------------------------------------------------------------------


def test_counts_of_strange_texts_equal_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    got = {r.doc_id: r for r in token_counts.token_counts(strange(spark), BYTES, limit=3, prefixes=True).collect()}
    for key, text in enumerate(STRANGE):
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (got[key].n_bytes, got[key].n_tokens, got[key].over_limit) == (len(text.encode()), n, n > 3), text
        held = got[key].prefixes
        assert len(held) == len(text.encode()) + 1 and held[0] == 0 and held[-1] == n
        assert got[key].fitting_bytes == max(i for i, c in enumerate(held) if c <= 3)
    assert (got[None].n_bytes, got[None].n_tokens) == (0, 0)


def test_every_prefix_of_a_word_equals_library():
    from tokenizers import Tokenizer

    library, known, draw = Tokenizer.from_file(BYTES), token_counts.vocabulary(BYTES), random.Random(2)
    words = ["".join(draw.choices("abcdefghinorst", k=draw.randint(1, 30))) for _ in range(300)]
    words += [" " + w for w in ("international", "unbelievably", "aaaaaaaaaaaaaaaa", "thththththing")] + ["qu" * 200]
    counts, first = known.prefix_counts([w.encode() for w in words])
    for i, word in enumerate(words):
        want = [len(library.encode(word[:k], add_special_tokens=False).ids) for k in range(1, len(word) + 1)]
        assert counts[first[i] : first[i + 1]].tolist() == want


def test_fitting_reads_stored_counts(spark):
    rows = token_counts.token_counts(strange(spark), BYTES, limit=5, prefixes=True)
    for r in rows.select("fitting_bytes", token_counts.fitting("prefixes", 5).alias("f")).collect():
        assert r.f == r.fitting_bytes


# --- SentencePiece -------------------------------------------------------------------------


def unigram_model(folder) -> str:
    """The same pieces as a unigram model with falling scores."""
    from sentencepiece import sentencepiece_model_pb2

    told = sentencepiece_model_pb2.ModelProto()
    with open(PIECES, "rb") as file:
        told.ParseFromString(file.read())
    told.trainer_spec.model_type = 1
    for i, piece in enumerate(told.pieces):
        if piece.type == 1:
            piece.score = -3 - math.log(i)
    path = folder / "unigram.model"
    path.write_bytes(told.SerializeToString())
    return str(path)


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_pieces_of_strange_texts_equal_library(spark, tmp_path, kind):
    import sentencepiece

    path = PIECES if kind == "bpe" else unigram_model(tmp_path)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    held = pieces.encoded(strange(spark), path, ids=True)
    got = {r.doc_id: r for r in held.collect()}
    for key, text in enumerate(STRANGE):
        ids = library.encode(text)
        if kind == "bpe":
            assert list(got[key].ids) == ids, text
        else:  # equal totals; the library may break ties another way
            total = sum(map(library.get_score, ids))
            assert sum(map(library.get_score, got[key].ids)) == pytest.approx(total, rel=1e-4), text
        assert got[key].round_trip == (library.decode(list(got[key].ids)) == text)
    assert got[None].n_pieces == 0
    texts = {r.doc_id: r.text for r in pieces.decoded(held, path).collect()}
    assert all(texts[key] == text for key, text in enumerate(STRANGE) if got[key].round_trip)


def test_units_are_cut_where_no_piece_has_both_sides(spark, monkeypatch):
    """A word's ids are found once, whatever marks follow it; the parts of a unit have its ids."""
    import sentencepiece

    model = pieces.read_model(PIECES)
    known, draw = pieces._known(model), random.Random(8)
    units = list(dict.fromkeys(u for _ in range(300) for u in model.cut("".join(draw.choice("aehnrst éß,.;!7中\n ") for _ in range(30)))))
    parts, starts = model.split(units)
    assert len(starts) == len(units) + 1 and len(parts) > len(units) > len(set(parts))
    for i, unit in enumerate(units):
        own = parts[starts[i] : starts[i + 1]]
        assert "".join(own) == unit
        assert [x for part in own for x in pieces.folded_in_place(part, known, model)] == pieces.folded_in_place(unit, known, model)

    told, write = {}, pieces.written_table

    def spied(df, name):
        told[name] = write(df, name)
        return told[name]

    monkeypatch.setattr(pieces, "written_table", spied)
    words = ["".join(draw.choice("aeinrst") for _ in range(8)) for _ in range(40)]
    text = " ".join(word + mark for mark in (",,", "?!", ".,") for word in words)
    rows = pieces.encoded(spark.createDataFrame([(1, text)], "doc_id long, text string"), PIECES, ids=True).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert list(rows[0].ids) == library.encode(text) and told["units"].count() < 100


def test_long_units_fold_as_short_ones(spark):
    model = pieces.read_model(PIECES)
    known, draw = pieces._known(model), random.Random(4)
    units = ["▁" + "".join(draw.choices("abehilnorst", k=draw.randint(1, 40))) for _ in range(60)]
    rows = spark.createDataFrame([(0, u) for u in sorted(set(units))], "bucket long, unit string")
    for r in pieces.unit_ids(rows, model).collect():
        assert list(r.ids) == pieces.folded_in_place(r.unit, known, model)


# --- fingerprints --------------------------------------------------------------------------


def test_walks_survive_edits():
    """A walk falls in step again after an edit, mostly soon, so the mean over some texts is held to a bound."""
    draw = random.Random(6)
    near, far = [], []
    for n in (200, 1000, 5000):
        for _ in range(12):
            text, stranger = ("".join(draw.choices("abcdefghij ", k=n)) for _ in range(2))
            at = draw.randrange(n)
            changed = draw.choice([text[:at] + "q" + text[at:], text[:at] + text[at + 1 :], text[:at] + "q" + text[at + 1 :]])
            own, close, other = fingerprints.fingerprints([text, changed, stranger])
            near.append(fingerprints.likeness(own, close))
            far.append(fingerprints.likeness(own, other))
    assert np.mean(near) > 0.7 and max(far) < 0.4


def test_fingerprints_do_not_depend_on_company():
    draw = random.Random(7)
    texts = ["".join(draw.choices("abc é中", k=k)) for k in (0, 1, 5, 42, 43, 100, 5000)]
    together = fingerprints.fingerprints(texts)
    assert together == [fingerprints.fingerprints([t])[0] for t in texts]
    assert fingerprints.likeness(together[0], together[0]) == 1 and fingerprints.likeness(together[0], together[3]) == 0


def test_next_document_follows_across_ranges(spark):
    rows = [(k, f"text {k} " * (k % 7)) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: r for r in fingerprints.fingerprinted(docs).collect()}
    assert len(got) == 60
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        changed = fingerprints.edited(text, after)
        assert got[key].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()


def test_odd_rows_have_fingerprints(spark, odd, empty):
    rows = fingerprints.fingerprinted(odd).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprints.fingerprinted(empty).count() == 0
    assert fingerprints.fingerprinted(odd.where("doc_id = 2")).count() == 1


def test_near_duplicates_meet_in_bands(spark):
    draw = random.Random(8)
    rows, key = [], 0
    for _ in range(20):
        base = "".join(draw.choices("abcdefghij ", k=2000))
        rows += [(key, base), (key + 1, base), (key + 2, base[:1950] + "zzz" + base[1953:])]
        key += 3
    prints = fingerprints.fingerprinted(spark.createDataFrame(rows, "doc_id long, text string"))
    links, members = fingerprints.near_documents(prints)
    found = {r.doc_id: (r.class_id, r.component_id) for r in members.collect()}
    assert all(found[k][0] == found[k + 1][0] == k for k in range(0, key, 3))
    assert sum(found[k + 2][1] == k for k in range(0, key, 3)) >= 18
    assert all(r.a < r.b and r.likeness >= 0.8 for r in links.collect())


# --- WARC ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>" + "word " * 60 + "</p>"
    rows = [(k, f"http://a/{k}\n", big if k % 3 == 0 else f"<p>{k}</p>" * (k % 5)) for k in range(40)]
    rows += [(3, "http://a/3", big), (None, None, big), (50, None, None), (51, "u", "short"), (52, "u", "short")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_archives_read_back(spark, pages):
    rows = warc.records(warc.archive(pages)).collect()
    assert len(rows) == pages.count()
    held = {}
    for p in pages.collect():
        held.setdefault(p.page_id, []).append(p.html or "")
    for r in rows:
        payload = held[r.page_id][0].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        again = r.page_id is not None and r.page_id % 3 == 0 and 0 < r.page_id < 40
        assert (r.record_type, r.refers_to) == (("revisit", 0) if again else ("response", None))


def test_bundles_seek_to_one_frame(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 600)
    out = warc._Bundle("b")
    for k in range(30):
        out.add(warc.record_id(k), warc.record(k, None, b"payload %d" % k, "0"))
    row = out.row().iloc[0]
    assert len(warc.frames_of(row["content"])) > 3
    for place in row["index"]:
        data = warc.frame(row["content"], place["frame"])[place["offset"] : place["offset"] + place["length"]]
        fields, block, end = warc.parsed(data)
        assert fields["WARC-Record-ID"] == place["record_id"] and end == len(data)
    import zstandard

    plain = zstandard.ZstdDecompressor().stream_reader(row["content"], read_across_frames=True).read()
    assert plain.count(b"WARC/1.1") == 30  # any reader of the format passes over the seek table


def test_fetch_by_id(spark, pages):
    bundles = warc.archive(pages)
    wanted = spark.createDataFrame([(7,), (50,), (999,)], "page_id long")
    got = {r.record_id: bytes(r.data) for r in warc.fetched(bundles, wanted).collect()}
    assert set(got) == {"<urn:page:7>", "<urn:page:50>"}
    assert got["<urn:page:7>"].endswith(b"<p>7</p><p>7</p>\r\n\r\n")


def test_no_pages_no_records(spark, pages):
    assert warc.records(warc.archive(pages.limit(0))).count() == 0


# --- chat ----------------------------------------------------------------------------------


def test_template_is_reversible(spark):
    texts = ["", "<|turn|>", "<~|end|>", "<~~|says|> </s> <~/s> [INST][~/INST]", "<<|turn|>>", "a~<|", "<s>[/INST]é😀"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    marked = rows.select("t", chat.escaped(rows.t).alias("e"))
    for r in marked.select("t", "e", chat.unescaped(marked.e).alias("u")).collect():
        assert r.u == r.t
        assert not any(mark in r.e for mark in (chat.TURN, chat.SAYS, chat.END, "</s>", "[INST]", "[/INST]"))


def test_odd_conversations(spark):
    rows = [
        (1, 0, "system", "be <|end|>"), (1, 2, "assistant", "two <|turn|>assistant<|says|>no"), (1, 1, "user", None),
        (1, 3, "user", "bye"), (1, 4, "assistant", ""), (2, 0, None, "x"), (2, 0, None, "x"), (3, None, "assistant", "é"),
        (None, 0, "assistant", "n"), (4, 1, "assistant", "b"), (4, 1, "assistant", "a"),
    ]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, start long")
    whole = chat.formatted(turns)
    got = {r.conv_id: r for r in chat.read_back(whole).collect()}
    for key in {r[0] for r in rows}:
        own = sorted(((-1 if r[1] is None else r[1], r[2] or "", r[3] or "") for r in rows if r[0] == key))
        told = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        assert got[key].n_turns == len(own)
        assert got[key].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert (got[key].loss_chars, got[key].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    spelt = [r for r in chat.example_texts(whole).collect() if r.conv_id == 1]
    assert len(spelt) == 2 and spelt[1].text.startswith(spelt[0].text) and spelt[0].text.endswith(chat.END)
    spans = {(r.conv_id, r.example): r for r in chat.examples(whole).collect()}
    assert all(spans[1, r.example].prefix_chars == len(r.text) for r in spelt)
    assert all(spans[1, r.example].loss == r.text[r.loss_start : r.loss_start + r.loss_chars] for r in spelt)
    outer = {(r.conv_id, r.example) for r in chat.examples(whole, "text", outer=True).collect()}
    assert outer == {*spans, (2, None)}, "a conversation without replies has a row of nulls"
    assert chat.read_back(chat.formatted(turns.limit(0))).count() == 0


def test_examples_hold_prefix_and_target(spark):
    rows = [(1, 0, "user", "a </s>"), (1, 1, "assistant", "é"), (1, 2, "user", "c"), (1, 3, "assistant", ""), (2, 0, "user", "x")]
    whole = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    text = {r.conv_id: r.text for r in whole.collect()}[1]
    got = sorted(chat.examples(whole).collect(), key=lambda r: r.example)
    assert [(r.conv_id, r.target, r.loss) for r in got] == [(1, "é" + chat.END, "é"), (1, chat.END, "")]
    assert all(r.prefix + r.target == text[: r.prefix_chars] and len(r.prefix) == r.loss_start for r in got)


# --- quality -------------------------------------------------------------------------------


def test_order_of_rules_does_not_matter(spark, data):
    from keytide.llm import queries

    docs = queries.documents(spark, data)
    for rules in itertools.islice(itertools.permutations(quality.RULES), 0, 120, 41):
        texts = [(r.text or "").encode() for r in docs.limit(60).collect()]
        batch = quality.Batch(texts)
        every = np.ones(batch.size, bool)
        want = np.logical_or.reduce([rule.rejects(batch) for rule in rules])
        assert np.array_equal(quality._rejected(batch, every, rules), want)


def test_cheap_rejections_come_first(spark):
    docs = spark.createDataFrame([(i, "$$ %% word" * 40) for i in range(30)], "doc_id long, text string")

    def slow(batch):
        import time

        time.sleep(0.05)
        return np.zeros(batch.size, bool)

    rules = (quality.Rule("slow", slow), quality.Rule("symbols", lambda b: b.n_symbols > 1))
    passing = spark.createDataFrame([(i, " ".join(f"w{i}x{j}$" for j in range(60))) for i in range(30)], docs.schema)
    assert quality.cascade_order(passing, "doc_id", "text", rules) == ["symbols", "slow"]


def test_odd_documents_are_rated(spark, odd, empty):
    rows = quality.rate(odd).collect()
    assert len(rows) == odd.count()
    assert [(r.n_words, r.n_dup_lines, r.base_failed, r.kept) for r in rows if r.doc_id == 3] == [(0, 0, True, False)]
    assert quality.rate(empty).count() == 0
    assert quality.kept(odd).columns == odd.columns


def test_a_worker_rates_little_text_at_a_time(spark, monkeypatch):
    """Measured, a text takes many times its size; little is measured at once, and memory is given back in between."""
    seen, batch, released = [], quality.Batch.__init__, quality.released
    monkeypatch.setattr(quality.Batch, "__init__", lambda self, texts: [seen.append(sum(map(len, texts)))] and batch(self, texts))
    monkeypatch.setattr(quality, "released", lambda: [seen.append(None)] and released())
    texts = [None, "", *["some words " * 10_000] * 30, None]
    found = [one.n_words.tolist() for one in quality._batches(pa.array(texts))]
    assert sum(found, []) == [0, 0, *[20_000] * 30, 0]
    sizes = [size for size in seen if size is not None]
    assert sum(sizes) == 30 * 110_000 and max(sizes) < 3 << 19
    assert seen[::2] == [None] * (len(sizes) + 1)


def test_other_tasks_do_not_hold_what_a_tokenizer_kept():
    """A worker runs tasks of all stages one after the other."""
    encoder = packing._encoder(WORDS)
    blocks.released(WORDS)
    assert packing._encoder(WORDS) is encoder
    list(quality._batches(pa.array(["some words"])))
    assert blocks.kept(WORDS, lambda: None) is None
    blocks.released()
    assert packing._encoder(WORDS) is not encoder


def test_classes_meet_behind_unlike_smaller_ones(spark):
    """Every band of b and c has smaller, unlike classes: the first 80 of 128 steps are the same in all."""
    draw = random.Random(4)
    head = bytes(draw.randrange(1, 256) for _ in range(80))
    tails = [bytes(draw.randrange(1, 256) for _ in range(48)) for _ in range(7)]
    prints = [(key, f"00{(head + tail).hex()}") for key, tail in enumerate(tails)]
    for key in (4, 6):
        near = bytearray(tails[key])
        near[3] ^= 1
        prints.append((100 + key, f"00{(head + bytes(near)).hex()}"))
    links, members = fingerprints.near_documents(spark.createDataFrame(prints, "doc_id long, fingerprint string"))
    want = [(a, b) for a, x in prints for b, y in prints if a < b and fingerprints.likeness(x, y) >= 0.8]
    assert want == [(4, 104), (6, 106)] == sorted((r.a, r.b) for r in links.collect())
    assert {r.doc_id: r.component_id for r in members.collect()} == {k: k % 100 for k, _ in prints}


# --- packing -------------------------------------------------------------------------------


def fewest(items, capacity):
    """The least number of bins, by trying everything."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def place(at, bins):
        if len(bins) >= best[0]:
            return
        if at == len(items):
            best[0] = len(bins)
            return
        seen = set()
        for i, room in enumerate(bins):
            if room >= items[at] and room not in seen:
                seen.add(room)
                place(at + 1, [*bins[:i], room - items[at], *bins[i + 1 :]])
        place(at + 1, [*bins, capacity - items[at]])

    place(0, [])
    return best[0]


def test_small_packings_are_the_best():
    draw = random.Random(9)
    gains = 0
    for _ in range(150):
        capacity = draw.choice([10, 20, 30])
        items = [draw.randint(2, capacity * 2 // 3) for _ in range(draw.randint(0, 11))]
        counts = {x: items.count(x) for x in items}
        found = packing.pack(counts, capacity, nodes=20_000)
        used = [x for pattern, bins in found for x in pattern * bins]
        assert sorted(used) == sorted(items) and all(sum(p) <= capacity for p, _ in found)
        bins = sum(n for _, n in found)
        assert bins == fewest(items, capacity)
        gains += bins < sum(n for _, n in packing.best_fit(counts, capacity))
    assert gains  # the search finds what best fit misses


def test_bound_never_exceeds_the_least():
    draw = random.Random(10)
    for _ in range(100):
        items = [draw.randint(1, 20) for _ in range(draw.randint(1, 9))]
        assert packing.least_bins({x: items.count(x) for x in items}, 20) <= fewest(items, 20)


def test_large_histograms_keep_every_piece():
    draw = random.Random(12)
    counts = {draw.randint(1, 4096): draw.randint(1, 100_000) for _ in range(600)}
    found = packing.pack(counts)
    used: dict = {}
    for pattern, bins in found:
        assert sum(pattern) <= 4096
        for x in pattern:
            used[x] = used.get(x, 0) + bins
    assert used == counts
    with pytest.raises(ValueError):
        packing.pack({5000: 1})


def bins_of(packing_):
    return sum(bins for _, bins in packing_)


def test_hot_lengths_are_searched_whole():
    """Production limits; the waste-free packing needs patterns that best fit never opens."""
    hot = {2058: 6, 1044: 6, 1034: 6, 1004: 12}
    for n in (1, 40, 1000, 1_000_000):
        counts = {x: m * n for x, m in hot.items()}
        found = packing.pack(counts)
        used: dict = {}
        for pattern, bins in found:
            assert sum(pattern) <= 4096
            for x in pattern:
                used[x] = used.get(x, 0) + bins
        assert used == counts and bins_of(found) == 9 * n == packing.least_bins(counts, 4096)
    assert bins_of(packing.best_fit({x: m * 1000 for x, m in hot.items()}, 4096)) == 11_000


def test_search_goes_on_after_bins_that_cannot_gain():
    """The bins with the most waste are one pattern that cannot be packed tighter; the gain lies in others."""
    counts = {2058: 6000, 1044: 6000, 1034: 6000, 1004: 12_000, 3100: 5000}
    assert bins_of(packing.best_fit(counts, 4096)) > 14_000 == bins_of(packing.pack(counts))
    noise = random.Random(7)
    for _ in range(60):
        length = noise.randint(1500, 2000)
        counts[length] = counts.get(length, 0) + noise.randint(1, 20)
    first, found = packing.best_fit(counts, 4096), packing.pack(counts)
    assert bins_of(first) - bins_of(found) > 1000


def test_lots_of_patterns_are_tried_until_none_gains(monkeypatch):
    """Where the search of the whole histogram finds nothing, lots of patterns are tried, past those that fail."""
    counts = {2058: 600, 1044: 600, 1034: 600, 1004: 1200, **{x: 50 for x in range(3093, 3102)}}
    search, lots = packing.search, []

    def tried(held, capacity, fewest, nodes):
        lots.append(len(held))
        return None if len(lots) <= 2 else search(held, capacity, fewest, nodes)

    monkeypatch.setattr(packing, "search", tried)
    monkeypatch.setattr(packing, "SEARCHED_ITEMS", 12)  # so that this histogram makes more than one lot
    assert bins_of(packing.pack(counts)) < bins_of(packing.best_fit(counts, 4096)) and len(lots) > 2


def test_without_bounds_the_search_is_exact():
    """No cap on nodes, fillings or steps: the least number of bins, where one step of work finds nothing."""
    draw = random.Random(19)
    for _ in range(60):
        capacity = draw.choice([20, 30, 50])
        items = [draw.randint(3, capacity // 2) for _ in range(draw.randint(6, 11))]
        counts = {x: items.count(x) for x in items}
        found = packing.pack(counts, capacity, nodes=None, steps=0)
        assert sorted(x for pattern, bins in found for x in pattern * bins) == sorted(items)
        assert bins_of(found) == fewest(items, capacity)
        assert bins_of(packing.pack(counts, capacity, steps=0)) == bins_of(packing.best_fit(counts, capacity))


@pytest.mark.parametrize("n", [2_000, 20_000, 2_000_000])
def test_the_whole_search_is_bounded(n):
    """A thousand lengths that no packing fits to the bound: some seconds, whatever the number of pieces."""
    draw, counts = random.Random(1), {}
    for _ in range(2_000):
        length = draw.randint(1000, 1999)
        counts[length] = counts.get(length, 0) + n // 2_000
    begin = time.process_time()
    found = packing.pack(counts)
    assert time.process_time() - begin < 60
    used: dict = {}
    for pattern, bins in found:
        assert sum(pattern) <= 4096
        for x in pattern:
            used[x] = used.get(x, 0) + bins
    assert used == counts and bins_of(found) < bins_of(packing.best_fit(counts, 4096))


def test_tiny_pieces_fill_a_bin_without_deep_recursion():
    assert sum(packing.fillings(4000, {1: 5000, 3: 2000})[0]) == 4000


def test_sequences_hold_all_ids(spark, odd, empty):
    held = packing.packed(odd, WORDS, capacity=64, ids=True)
    rows = held.collect()
    assert sum(r.piece == 0 for r in rows) == odd.count()
    joined = {r.sequence_id: list(r.ids) for r in packing.sequences(held).collect()}
    for r in rows:
        assert joined[r.sequence_id][r.offset : r.offset + r.length] == list(r.ids)
    assert sum(map(len, joined.values())) == sum(r.length for r in rows)
    assert packing.packed(empty, WORDS).count() == 0


def test_units_encode_as_whole_texts(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    got: dict = {}
    for r in packing.tokenized(strange(spark), WORDS, ids=True).orderBy("doc_id", "piece").collect():
        got.setdefault(r.doc_id, []).extend(r.ids)
    for key, text in enumerate(STRANGE):
        assert got[key] == [*library.encode(text, add_special_tokens=False).ids, 1], text
    assert got[None] == [1]


@pytest.mark.parametrize("kept", [packing.KEPT_UNITS, 700, 0])
def test_folded_units_encode_as_the_library_does(kept, monkeypatch):
    """Letters that combine, marks that run into words, special tokens in other cases, spaces of all kinds."""
    from tokenizers import Tokenizer

    signs = [
        "a", "B", "é", "É", "H̱", "ẖ", "É", "İ", "ß", "Σ", "'s", "'S", "'", "’", "!", ".", "%%", "<",
        "<|endoftext|>", "<|ENDOFTEXT|>", "≠", "…", "×", "÷", "7", "٣", "中", "하", "क़", "K",
        " ", "  ", "\n", "\x1c", "\xa0", "\x85", "-", "_", "`", "~", "‍", "😀", "</w>", "ﬁ", "\x00", "won't", "I'M", "'re.",
    ]
    draw = random.Random(3)
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    monkeypatch.setattr(packing, "KEPT_UNITS", kept)  # a worker remembers all, some or none
    encoder, raw = packing._Encoder(WORDS), [text.encode() for text in texts]
    got = [ids for low in range(0, 3000, 500) for ids in encoder.encode(raw[low : low + 500])]
    assert encoder.encode(raw[:500]) == got[:500]
    library = Tokenizer.from_file(WORDS)
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_a_worker_splits_little_text_at_a_time(spark, monkeypatch):
    """Split, a text takes many times its size, so few megabytes are split at once, whatever the batch."""

    class Docs:  # keeps what would run in the tasks
        select = lambda self, *_: self
        mapInPandas = lambda self, work, _: work

    seen, encode = [], packing._Encoder.encode
    monkeypatch.setattr(packing._Encoder, "encode", lambda self, texts: [seen.append(sum(map(len, texts)))] and encode(self, texts))
    rows = pd.DataFrame({"doc_id": range(60), "text": ["some words " * 10_000] * 60})
    found = pd.concat(packing.tokenized(Docs(), WORDS)(iter([rows])))
    assert sum(seen) == 60 * 110_000 and max(seen) < 3 << 20
    assert found.groupby("doc_id")["length"].sum().nunique() == 1 and found["doc_id"].nunique() == 60
