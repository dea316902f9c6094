"""Near duplicates, repeats, decontamination, chat and the pipeline against brute force."""

import hashlib
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import chat, components, decontaminate, jaccard, queries, repeats
from tests.llm.tables import SCHEMA, corpus, frame

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_groups(rows):
    """Index of each row's group, by linking all pairs."""
    sets = [shingles(r[1]) for r in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                up[root(i)] = root(j)
    return sets, [root(i) for i in range(len(rows))]


@pytest.mark.parametrize("block", [256, 4])
def test_near_duplicates(docs, rows, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    sets, group = brute_groups(rows)
    least = {}
    for r, s, g in zip(rows, sets, group, strict=True):
        if s and r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    want = sorted(((r[0], len(s), least.get(g) if s else r[0]) for r, s, g in zip(rows, sets, group, strict=True)), key=str)
    got = sorted((tuple(r) for r in jaccard.near_duplicates(docs).collect()), key=str)
    assert got == want and len(set(group)) < len(rows) - 20


@pytest.mark.parametrize("block", [256, 4])
def test_similarity_join_has_every_link(docs, rows, empty, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    sets, _ = brute_groups(rows)
    alike = lambda x, y: bool(x and y) and 100 * len(x & y) >= 75 * len(x | y)
    want = sorted(((r[0], len(s), sum(alike(s, o) for o in sets) - bool(s)) for r, s in zip(rows, sets, strict=True)), key=str)
    members, links = jaccard.similarity_join(docs)
    got = members.collect()
    assert sorted(((r.doc_id, r.n_shingles, r.n_links) for r in got), key=str) == want
    different = list({frozenset(s) for s in sets if s})
    assert links.count() == links.distinct().count() == sum(alike(x, y) for i, x in enumerate(different) for y in different[:i])
    assert {r.node for r in got if r.n_shingles == 0} <= {None}
    members, links = jaccard.similarity_join(empty)
    assert members.count() == links.count() == 0


def test_keep_one(docs, rows, empty):
    sets, group = brute_groups(rows)
    got = jaccard.keep_one(docs.unionByName(docs.limit(0)))
    assert got.columns == docs.columns
    kept = [tuple(r) for r in got.collect()]
    want = {min(i for i in range(len(rows)) if group[i] == g and rows[i][0] is not None) for g in set(group) if any(
        rows[i][0] is not None for i in range(len(rows)) if group[i] == g)} | {i for i, s in enumerate(sets) if not s}
    want |= {i for i, g in enumerate(group) if all(rows[j][0] is None for j in range(len(rows)) if group[j] == g)}
    assert sorted(kept, key=str) == sorted((rows[i] for i in want), key=str)
    assert jaccard.keep_one(empty).count() == 0 and jaccard.near_duplicates(empty).count() == 0
    twice = docs.unionByName(docs)
    assert sorted((tuple(r) for r in jaccard.keep_one(twice).where("length(text) > 5 and text rlike '[a-z]'").collect()), key=str) == \
        sorted((r for r in kept if r[1] and len(r[1]) > 5 and re.search("[a-z]", r[1])), key=str)


def test_no_bucket_takes_a_whole_group(spark, monkeypatch):
    copies = [(i, "one text that is there again and again") for i in range(1500)] + [(i, " ") for i in range(1500, 2000)]
    common = "these nine words are in all of the others"
    texts = copies + [(i, f"{common} " + " ".join(f"w{i}x{k}" for k in range(12))) for i in range(2000, 4000)]
    seen, count = [], jaccard._frequencies
    monkeypatch.setattr(jaccard, "_frequencies", lambda rows, *a: seen.append(rows) or count(rows, *a))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string").repartition(4)).collect()}
        size = sum((F.octet_length(c) for c in seen[0].columns if c != "bucket"), F.lit(0))
        sizes = [r["s"] for r in seen[0].groupBy("bucket").agg(F.sum(size).alias("s")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == {i: 0 if i < 1500 else i for i in range(4000)}
    assert len(sizes) == 32 and max(sizes) < 1.5 * sum(sizes) / 32, (max(sizes), sum(sizes) / 32)


@pytest.mark.parametrize("least", [1, 8])
def test_near_duplicates_with_hot_tokens(docs, rows, least, monkeypatch):
    monkeypatch.setattr(jaccard, "HOT_LEAST", least)
    monkeypatch.setattr(jaccard, "HOT_SHARE", 1 << 16)
    sets, group = brute_groups(rows)
    least_id = {}
    for r, s, g in zip(rows, sets, group, strict=True):
        if s and r[0] is not None:
            least_id[g] = min(least_id.get(g, r[0]), r[0])
    want = sorted(((r[0], len(s), least_id.get(g) if s else r[0]) for r, s, g in zip(rows, sets, group, strict=True)), key=str)
    assert sorted((tuple(r) for r in jaccard.near_duplicates(docs).collect()), key=str) == want


def test_set_of_repeated_shingles_links_by_the_exact_share(spark):
    # 3 of 4 shingles shared out of 4: linked at exactly 0.75; 3 of 5 is not
    base = [f"w{i}" for i in range(7)]
    pairs = [(1, " ".join(base)), (2, " ".join(base) + " extra"), (3, " ".join(base) + " other more")]
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(pairs, "doc_id long, text string")).collect()}
    assert got[1] == got[2] == 1 and got[3] == 3


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 901)], "a long, b long")
    got = {r.node: r.comp for r in components.components(links).collect()}
    assert got == {i: 0 for i in range(301)} | {900: 900, 901: 900}


def brute_repeats(rows, size=100):
    seen, out = set(), []
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            w = b[k:k + size]
            if w in seen:
                gone[k:k + size] = b"\1" * size
            seen.add(w)
        kept = bytes(x for x, z in zip(b, gone, strict=True) if not z)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_repeats(docs, rows, empty, monkeypatch):
    known = [r for r in rows if r[0] is not None]
    want = brute_repeats(known)
    plain = docs.where("doc_id is not null")
    assert sorted((tuple(r) for r in repeats.repeats_report(plain).collect()), key=str) == want
    assert sum(w[2] for w in want) > 10_000
    monkeypatch.setattr(repeats, "SEGMENT_BYTES", 3000)  # long texts in pieces
    assert sorted((tuple(r) for r in repeats.repeats_report(plain).collect()), key=str) == want
    assert repeats.repeats_report(empty).count() == 0


def test_repeated_rows_keep_the_first(spark):
    text = "".join(chr(97 + i * i % 26) for i in range(90)) + "Z" * 5 + "".join(chr(97 + i * 7 % 26) for i in range(60))
    rows = [(1, text)] * 3 + [(2, text), (2, "short"), (2, "short"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans) for r in repeats.repeats_report(df).collect())
    n = len(text.encode())
    assert got == [(0, 0, 0, 0), (1, n, 0, 0), (1, n, n, 1), (1, n, n, 1), (2, 5, 0, 0), (2, 5, 0, 0), (2, n, n, 1)]
    left = sorted((r.doc_id or 0, r.text or "") for r in repeats.remove_repeats(df.withColumn("cover", F.lit(1)).withColumn("copies", F.lit("c"))).collect())
    assert left == [(0, ""), (1, ""), (1, ""), (1, text), (2, ""), (2, "short"), (2, "short")]


def test_repeated_rows_in_one_chunk_keep_the_first(spark):
    text = "".join(chr(97 + i * i % 26) for i in range(90)) + "Z" * 5 + "".join(chr(97 + i * 7 % 26) for i in range(60))
    n = len(text)
    for ids in ([1, 1, 1, 2], [None, None, 5, 5]):
        df = spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string").coalesce(1)
        got = sorted((r.n_removed, r.doc_id is None, r.doc_id or 0) for r in repeats.repeats_report(df).collect())
        assert got[0] == (0, ids[0] is None, ids[0] or 0) and [g[0] for g in got[1:]] == [n] * 3
        assert sorted(r.text for r in repeats.remove_repeats(df).collect()) == ["", "", "", text]


def test_remove_repeats_keeps_whole_characters(docs, rows):
    got = repeats.remove_repeats(docs)
    assert got.columns == docs.columns and got.count() == len(rows)
    assert got.where("text is not null and n_chars <> length(text)").count() == 0


def brute_hits(rows, items, size=10):
    pat = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for i, t in items:
        w = pat.findall(lower(t)) if i is not None else []
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add(i)
    out = []
    for i, t, *_ in rows:
        w = pat.findall(lower(t))
        hit, ids = set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if (key := tuple(w[k:k + n])) in windows:
                    hit.update(range(k, k + n))
                    ids |= windows[key]
        names = ",".join(sorted(map(str, ids)))
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_contamination(spark, docs, rows, empty, monkeypatch):
    w = rows[40][1].split()
    items = [(1, rows[40][1]), (2, rows[40][1]), (3, " ".join(w[:4])), (10, " ".join(rows[60][1].split()[3:25])), (4, None), (None, "a b"), (5, ""), (6, "日本語"),
             (7, "not there at all in any document of this small corpus")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_hits(rows, items)
    assert sorted((tuple(r) for r in decontaminate.contamination_report(docs, bench).collect()), key=str) == want
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 20)
    split = decontaminate.query_blocks
    monkeypatch.setattr(decontaminate, "query_blocks", lambda i, n: split(i, n, 20))  # several blocks of test items
    assert sorted((tuple(r) for r in decontaminate.contamination_report(docs, bench).collect()), key=str) == want
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not x[-1] for x in want)
    assert decontaminate.contamination_report(empty, bench).count() == 0
    assert decontaminate.contamination_report(docs, bench.limit(0)).where("contaminated").count() == 0


def test_one_index_answers_any_test_set(spark, docs, rows):
    index = decontaminate.build_index(docs)
    for take in (rows[40][1], rows[60][1]):
        items = [(1, take), (2, "not there at all in any document of this small corpus")]
        found = decontaminate.search(index, spark.createDataFrame(items, "item_id long, text string"))
        want = {x[0] for x in brute_hits(rows, items) if x[-1]}
        assert want and {r.doc_id for r in found.collect()} == want
    pos = np.array([0, 3, 70000, 5, 6, 2**31 - 1, 1])
    assert decontaminate._unpacked(decontaminate._packed(pos)).tolist() == pos.tolist()


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "one two x three four"), (2, "four three two one"), (3, "one two three"), (4, "one two three " + "x " * 9 + "four")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "one two three four")], "item_id long, text string")
    _, found = decontaminate.find_matches(docs, items, slop=4)
    assert {r.doc_id for r in found.where("kind = 'near'").collect()} == {1, 2}
    assert found.where("kind = 'phrase'").count() == 0


def test_chat_recovers_marked_turns(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = {}
    for r in sorted(chat.chat_report(d).collect(), key=lambda r: (r.conv_id, r.turn, r.piece)):
        got.setdefault((r.conv_id, r.turn), [r.role, ""])[1] += r.rendered
    first = [(r.conv_id, r.text.split("\n")[0]) for r in chat.print_transcripts(d).collect()]
    unmarked = {c for c, line in first if chat.marker(line)[0] >= len(chat.ROLES)}
    true = [r for r in d.collect() if r.conv_id not in unmarked]
    exact = sum(got.get((r.conv_id, r.turn)) == [r.role, f"<|{r.role}|>\n{r.text}\n<|end|>\n"] for r in true)
    assert len(true) > 50 and exact > 0.97 * len(true), (exact, len(true))


def test_chat_viterbi_against_all_paths():
    rng = np.random.default_rng(3)
    states = range(chat.STATES)
    for trial in range(4):
        model = chat.Model.from_counts(rng.random(chat.STATES) * 5, rng.random((chat.STATES, chat.STATES)) * 9,
                                       rng.random((chat.STATES, chat._MARKS)) * 9, rng.random((chat.STATES, chat._SIZES)) * 9)
        obs = rng.integers(0, chat._OBS, 5)
        score = lambda path: model.start[path[0]] + model.emit[path[0], obs[0]] + sum(
            model.step[a, b] + model.emit[b, o] for a, b, o in zip(path[:-1], path[1:], obs[1:], strict=True))
        best = max(itertools.product(states, repeat=5), key=score)
        assert chat.transfer(obs, model, True)[0].max() == pytest.approx(score(best))
        # in two blocks: the first opens, the second is entered from the state that the first ended on
        for cut in (1, 3):
            head, tail = chat.transfer(obs[:cut], model, True), chat.transfer(obs[cut:], model, False)
            through = head[0][:, None] + tail
            mid, last = np.unravel_index(through.argmax(), through.shape)
            path = [*chat.decode(obs[:cut], model, True, 0, mid), *chat.decode(obs[cut:], model, False, mid, last)]
            assert through.max() == pytest.approx(score(best)) and score(path) == pytest.approx(score(best))


def test_chat_counts_openings_and_transitions(spark):
    said = [(1, 0, "system", "a"), (1, 1, "user", "b\nc\nd"), (1, 2, "assistant", "e"), (2, 0, "user", "f"), (2, 1, "assistant", "g"), (2, 2, "user", "h"),
            (None, 0, "user", "i"), (3, 0, "other", "j")]
    seen = {}
    keep = chat.Model.from_counts
    try:
        chat.Model.from_counts = classmethod(lambda cls, *t: seen.update(zip(("start", "step", "mark", "size"), t, strict=True)) or keep(*t))
        chat.train(spark.createDataFrame(said, "conv_id long, turn long, role string, text string").repartition(3))
    finally:
        chat.Model.from_counts = keep
    assert seen["start"].tolist() == [1, 0, 2, 0, 0, 0]
    step = np.zeros((6, 6))
    for a, b in ((0, 1), (1, 2), (1, 2), (2, 1)):  # system-user, user-assistant twice, assistant-user
        step[2 * a:2 * a + 2, 2 * b] += 1
    step[2, 3] += 1   # the one turn of three lines
    step[3, 3] += 1
    assert seen["step"].tolist() == step.tolist() and seen["mark"].sum() == 9 == seen["size"].sum()


def test_chat_without_markers_beats_the_most_frequent_role(spark):
    """Where no marker is printed only lengths and the order of roles speak: figures in the README."""
    d = spark.read.parquet("/root/testdata/sf0.1/conversations.parquet")
    printed = chat.print_transcripts(d)
    held = F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % 5 == 0
    model = chat.train(printed.where(~held))
    opening = {(r.conv_id, r.turn): (chat.marker(r.text.split("\n")[0])[0], r.role) for r in printed.where(held).collect()}
    got = {}
    for r in chat.parse(printed.where(held), model).orderBy("conv_id", "turn", "piece").collect():
        got.setdefault(r.conv_id, []).extend([r.role] * r.n_lines)
    right, lines = {True: [], False: []}, {}
    for r in sorted(printed.where(held).collect(), key=lambda r: (r.conv_id, r.turn)):
        at = lines.get(r.conv_id, 0)
        right[chat.marker(r.text.split("\n")[0])[0] < len(chat.ROLES)].append(got[r.conv_id][at] == r.role)
        lines[r.conv_id] = at + len(r.text.split("\n"))
    marked, unmarked = (sum(v) / len(v) for v in (right[True], right[False]))
    share = max(sum(role == x for _, role in opening.values()) for x in chat.ROLES) / len(opening)
    print("first lines of turns: marked", marked, "unmarked", unmarked, "most frequent role", share)
    assert marked > 0.99 and unmarked > share + 0.05


def test_chat_blocks_and_edges(spark, monkeypatch):
    lines = [(1, t, None, f"User: hello {t}\nmore <|x|>" if t % 2 == 0 else f"Assistant: hi {t}\nand\nso on") for t in range(60)]
    lines += [(2, 0, None, None), (None, 0, None, "### system\nbe kind"), (3, None, None, "no marker"), (3, 1, None, "A: yes"), (3, 1, None, "A: yes")]
    df = spark.createDataFrame(lines, "conv_id long, turn long, role string, text string").repartition(4)
    said = [("system", "### system\nrules"), *[("user", "User: hello 5\nmore words"), ("assistant", "Assistant: hi 5\nand\nso on")] * 3]
    labelled = spark.createDataFrame([(c, t, r, x) for c in range(20) for t, (r, x) in enumerate(said[c % 2:])],
                                     "conv_id long, turn long, role string, text string")
    model = chat.train(labelled)

    def turns():
        out = {}
        for r in sorted(chat.parse(df, model).collect(), key=lambda r: (r.conv_id or -1, r.turn, r.piece)):
            out.setdefault((r.conv_id, r.turn), [r.role, ""])[1] += r.rendered
        return out

    whole = turns()
    assert whole[(1, 0)] == ["user", "<|user|>\nhello 0\nmore <\\|x|>\n<|end|>\n"]
    assert [whole[(1, t)][0] for t in range(60)] == ["user", "assistant"] * 30
    assert whole[(None, 0)][1] == "<|system|>\nbe kind\n<|end|>\n"
    for size in (1, 2, 7):  # a conversation over many blocks
        monkeypatch.setattr(chat, "BLOCK", size)
        assert turns() == whole
    assert chat.parse(df.limit(0), model).count() == 0 and chat.train(labelled.limit(0)).step.shape == (6, 6)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        docs = corpus_pipeline.written(out, "test")
    assert 0 < docs.count() < spark.read.parquet(f"{SF}/documents.parquet").count()
    assert docs.where("not round_trip").count() == 0
    assert docs.count() == corpus_pipeline.run(spark, SF).count()


def test_pipeline_stages_on_odd_rows(spark, docs, rows, empty):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() <= len(rows), name
        assert stage(spark, empty, SF).count() == 0, name


def test_pipeline_stages_keep_columns_of_any_name(spark, docs, rows):
    names = ["toxic_verdict", "kept_id", "Text_Hash", "nth", "_nth", "_tx", "_toxic", "_dirty", "dirty_text", "_copies", "_cover", "_copy", "_chunk", "comp", "node", "row"]
    wide = docs.select("*", *[F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("?"))).alias(c) for c in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, SF)
        assert out.columns == wide.columns, name
        for r in out.select("doc_id", *names).collect():
            assert all(r[c] == f"{c}-{'?' if r.doc_id is None else r.doc_id}" for c in names), name


def test_only_ascii_blanks_are_wordless(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(["\u2028", "\u2028", "\u0085", " \t\n", " \r\n", "\u00a0"])], SCHEMA)
    groups = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
    assert groups == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 5}
    assert sorted(r.doc_id for r in jaccard.keep_one(docs).collect()) == [0, 2, 3, 4, 5]


def test_all_queries_are_registered():
    import __spark_entry__ as entry
    assert {n for n in entry.queries() if n.startswith("op")} == set(queries.QUERIES) and len(queries.QUERIES) == 13
    assert "pipeline" in entry.queries()
