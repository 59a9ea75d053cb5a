"""The operators on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
import warnings
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidelog.llm import chat, decontam, onebit, pii, probminhash, raking, secretscan, tokenfile, toxicity, urlrules
from tidelog.llm.components import connected

CLASHING = ", node string, band int, label string, class_id int, a int, b int, topic string, n_tokens string, span int, toxic_score string, rank int"
DOC = "doc_id long, text string, lang string, source string" + CLASHING
EXTRA = ("n", 1, "l", 2, 3, 4, "t", "k", 5, "s", 6)


def documents(spark, rows):
    """Rows of (doc_id, text) with other columns whose names the operators use themselves."""
    full = [(i, t, [None, "en", "de"][k % 3], [None, "s1", "s2"][k // 3 % 3], *EXTRA) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOC).repartition(3)


def sentence(draw, n):
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(n))


def edited(draw, text, edits):
    words = text.split()
    for k in draw.sample(range(len(words)), edits):
        words[k] = "edit" + str(draw.random())[2:6]
    return " ".join(words)


def jaccard(x, y):
    sets = []
    for t in (x, y):
        w = re.findall(r"[0-9A-Za-z]+", t.lower())
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1]) if sets[0] and sets[1] else 0.0


def test_near_duplicates_equal_brute_force(spark):
    draw = random.Random(1)
    texts = []
    for _ in range(12):
        base = sentence(draw, 120)
        texts += [base, base.upper()] + [edited(draw, base, draw.randint(1, 4)) for _ in range(4)]
    chain = [sentence(draw, 120)]
    for _ in range(6):  # neighbours are alike, ends are not
        chain.append(edited(draw, chain[-1], 2))
    texts += chain + [texts[0]] * 30 + ["one two", "one two", "", None, "...", "x " * 20_000]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[0])]
    members, links = probminhash.near_duplicates(documents(spark, rows))
    got = {}
    for m in members.collect():
        got.setdefault(m.doc_id, set()).add(m.class_id)
    parent = list(range(len(texts)))
    find = lambda i: i if parent[i] == i else find(parent[i])
    plain = [t or "" for t in texts]
    for i, j in combinations(range(len(texts)), 2):
        if plain[i] == plain[j] or jaccard(plain[i], plain[j]) >= 0.8:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    assert {i: got[i] for i in range(len(texts))} == {i: {find(i)} for i in range(len(texts))}
    assert got[None] == {0} and links.where("similarity < 0.8").isEmpty()
    sizes = {m.doc_id: m.class_size for m in members.collect()}
    assert sizes[0] == sum(find(i) == 0 for i in range(len(texts))) + 2 * (0 == find(3)) - (0 == find(3)) + 1
    kept = probminhash.deduplicated(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({find(i) for i in range(len(texts))})


def test_null_id_beside_near_copies_keeps_one_row(spark):
    draw = random.Random(12)
    base, lone = sentence(draw, 120), sentence(draw, 120)
    rows = [(5, base), (7, edited(draw, base, 2)), (None, edited(draw, base, 2)), (None, edited(draw, base, 1)), (None, lone), (None, edited(draw, lone, 2))]
    members, _ = probminhash.near_duplicates(documents(spark, rows))
    assert sorted((m.class_id or -1, m.class_size) for m in members.collect()) == [(-1, 2)] * 2 + [(5, 4)] * 4
    kept = probminhash.deduplicated(documents(spark, rows)).collect()
    assert sorted(r.doc_id or -1 for r in kept) == [-1, 5]


def test_components_of_stars_chains_and_cycles(spark):
    edges = [(0, i) for i in range(1, 50)] + [(i, i + 1) for i in range(100, 140)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    labels = connected(spark.createDataFrame(edges, "a long, b long"))
    got = {r.node: r.label for r in labels.collect()}
    assert got == {**{i: 0 for i in range(50)}, **{i: 100 for i in range(100, 141)}, **{i: 200 for i in (200, 201, 202)}}
    assert connected(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_raking_meets_its_margins(spark):
    draw = random.Random(2)
    rows = [(i, sentence(draw, draw.randint(1, 60)) + " %%%%" * (i % 5 == 0)) for i in range(400)] + [(900, None), (None, ""), (5, "again")]
    wanted = {"source": 0.5, "lang": {"en": 0.6, "de": 0.3}, "topic": 1.0}
    docs = documents(spark, rows)
    drawn = {(r.doc_id, r.n_tokens): r for r in raking.mix(docs, wanted).collect()}
    cells = raking.classified(docs).groupBy(*raking.MARGINS).agg(F.sum("n_tokens").alias("tokens"))
    raked = raking.rake(cells, wanted)
    for margin, target in wanted.items():
        goal = {r[0]: r[1] for r in raking.targets(cells, margin, target).collect()}
        now = {r[0]: r[1] for r in raked.groupBy(margin).agg(F.sum(F.col("tokens") * F.col("factor"))).collect()}
        assert all(now[v] == pytest.approx(goal[v], rel=1e-3) for v in goal)
    assert 0 < len(drawn) < len(rows) and all(0 < r.probability <= 1 for r in drawn.values())
    again = raking.mixed_rows(docs, wanted)
    assert again.columns == docs.columns and sorted(r.doc_id or -1 for r in again.collect()) == sorted(k[0] or -1 for k in drawn)
    assert raking.mix(documents(spark, []), wanted).isEmpty()


def test_raking_reports_margins_it_cannot_meet(spark):
    cell = "source string, lang string, topic string, tokens long"
    rows = [(s, v, "prose", 1000 + 100 * k) for k, (s, v) in enumerate([("a", "en"), ("a", "de"), ("b", "en"), ("b", "de")])]
    wanted = {"source": 0.5, "lang": {"en": 0.5, "de": 0.3}, "topic": 0.8}
    with pytest.warns(UserWarning, match=r"source=\(none\) off by 9"):  # its source asks for more than its language
        raking.rake(spark.createDataFrame([*rows, ("(none)", "(none)", "prose", 3)], cell), wanted, rounds=4)
    # Two rounds leave an error of over 1 %.
    slow = spark.createDataFrame([("a", "en", "prose", 1000), ("a", "de", "prose", 20), ("b", "de", "prose", 1000), ("b", "en", "prose", 20)], cell)
    wanted = {"source": {"a": 0.8, "b": 0.2}, "lang": {"en": 0.3, "de": 0.7}}
    goals = {m: raking.targets(slow, m, t) for m, t in wanted.items()}
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        raked = raking.rake(slow, wanted, rounds=2)
    assert raking.margin_errors(raked, goals).agg(F.max("error")).first()[0] <= raking.TOLERANCE


def test_toxicity_scores_every_row(spark):
    draw = random.Random(3)
    make = lambda bad: sentence(draw, 30) + " vilewort" * bad + " " + sentence(draw, 30)
    rows = [(i, make(i % 3 == 0)) for i in range(240)] + [(1000, None), (1001, ""), (1002, make(False) * 300), (1003, make(False) * 200 + " vilewort"), (None, "x"), (0, make(True))]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)] + [(5, None), (None, 1)], "doc_id long, toxic int")
    net = toxicity.trained(docs, labels)
    scored = toxicity.score(docs, net)
    assert sorted(scored.columns) == sorted(docs.columns)
    got = [(r.doc_id, r.toxic_score) for r in scored.collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, s in got)
    held = [(i, s >= 0.5) for i, s in got if i is not None and i < 240 and zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(p == (i % 3 == 0) for i, p in held) / len(held) > 0.85
    by = dict(got)
    assert by[1003] >= 0.5 > by[1001]
    assert [r[0] for r in spark.range(50).where(toxicity.held_out(F.col("id"))).collect()] == [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 0]
    empty = toxicity.trained(documents(spark, []), labels)
    assert toxicity.score(documents(spark, []), empty).isEmpty()


def test_chats_come_back(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    control = "</s>[INST] ok [/INST]<|turn|>\\-"
    turns = [(1, 0, "user", control), (1, 1, "assistant", control), (1, 1, "assistant", control), (1, 3, None, None), (2, None, "assistant", "")]
    turns += [(3, t, "assistant" if t % 2 else "user", f"é {t} \n<|end|>") for t in range(700)] + [(4, 0, "system", "x" * 60_000), (None, 0, "user", "n")]
    rows = spark.createDataFrame([(*t, "z", "y") for t in turns], "conv_id long, turn long, role string, text string, ids string, start string")
    folder = chat.write_chats(rows.repartition(5), path)
    got = {r.conv_id: r for r in chat.read_chats(spark, folder, path).collect()}
    for conv in (1, 2, 3, 4, None):
        own = [(r or "", t or "") for c, n, r, t in sorted(turns, key=lambda t: (t[0] or -1, t[1] if t[1] is not None else -1)) if c == conv]
        learned = "".join(t for r, t in own if r == "assistant")
        row = got[conv]
        assert (row.n_turns, row.loss_chars) == (len(own), len(learned))
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    written = spark.read.parquet(folder)
    assert written.where(F.size("ids") != F.size("loss_mask")).isEmpty()
    placed = [(r.start, len(r.ids)) for r in written.where("conv_id = 3").orderBy("turn").collect()]
    assert all(a + n == b for (a, n), (b, _) in zip(placed, placed[1:])) and placed[0][0] == 0
    nothing = spark.createDataFrame([], rows.schema)
    assert chat.read_chats(spark, chat.write_chats(nothing, path), path).isEmpty()


def test_token_files_come_back(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    draw = random.Random(4)
    rows = [(i, sentence(draw, draw.randint(0, 40))) for i in range(300)] + [(-5, None), (7, "again"), (None, "no id"), (999, "long " * 30_000), (1000, "<|endoftext|>")]
    got = tokenfile.read_blocks(spark, tokenfile.token_files(documents(spark, rows), path, 1)).orderBy("start").collect()
    tokenizer = tokenfile.PieceEncoder(path).tokenizer
    wanted = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]
    assert sorted((str(r.doc_id), list(r.ids)) for r in got) == sorted((str(i), ids) for i, ids in wanted)
    start = 0
    for row in got:
        assert (row.start, row.n_tokens) == (start, len(row.ids))
        assert row.ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())
        start += row.n_tokens
    known = [r.doc_id for r in got[1:]]
    assert got[0].doc_id is None and known == sorted(known)
    assert tokenfile.read_blocks(spark, tokenfile.token_files(documents(spark, []), path, 1)).isEmpty()


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = [int(c) for c in re.sub("[^0-9]", "", match)]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "phone":
        return 10 <= len(digits) <= 15
    doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
    return kind == "email" or 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0


def test_personal_data_equals_the_plain_patterns(spark):
    draw = random.Random(5)
    parts = ["a", "b.c", "@", "@x.y", ".com", "1", "12", "255", "256", ".", "4111 1111 1111 1111", "5500-0000-0000-0004", "+49", " ", "-", "(", "30", ") 123456", "é", "\n", "_", "%", "😀"]
    rows = [(i, "".join(draw.choice(parts) for _ in range(draw.randint(0, 16)))) for i in range(800)]
    rows += [(900, None), (901, ""), (902, "a@" + "b." * 20_000 + "c"), (903, "1 " * 30_000), (904, "@" * 3000), (905, "tel: 1234567890 and phone 555 123 4567"), (1, "me@x.org"), (None, "1.2.3.4")]
    got = pii.personal_data(documents(spark, rows)).collect()
    plain = {}
    for i, t in rows:
        spans = [(m.start(), n, k, m.end()) for n, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, t or "") if passes(k, m.group())]
        plain.setdefault(i, []).append([(a, k, b) for a, _, k, b in sorted(spans)])
    seen = {}
    for r in got:
        seen.setdefault(r.doc_id, []).append([(s.start, s.kind, s.end) for s in r.spans if s.kind in PATTERNS])
    assert {k: sorted(map(str, v)) for k, v in seen.items()} == {k: sorted(map(str, v)) for k, v in plain.items()}
    assert len([s for r in got if r.doc_id == 905 for s in r.spans if s.kind == "number"]) == 2
    assert pii.personal_data(documents(spark, [])).isEmpty()


def test_rules_equal_brute_force(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.net", "/", "allow"), ("a.example.net", "/en/x", "block"), ("", "/all", "block"), ("org", None, "allow"), ("org", "", "block"), ("net", "/", "block")]
    draw = random.Random(6)
    hosts = ["net", "EXAMPLE.net", "a.example.net", "b.a.example.net", "badexample.net", "org", "x.org", "", "com"]
    paths = ["", "/", "/en/", "/en/x/y", "/en", "/all/x", "/e?n/", "#/en/"]
    urls = [f"{s}{h}{p}" for s in ("http://", "https://") for h in hosts for p in paths] + [None, "", "net/", "x://", "a://b://net/"] + ["http://net/hot"] * 200
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)] + [(None, "http://net/", "x", "y")], "page_id long, url string, host string, key string")
    got = {r.page_id: r for r in urlrules.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    clean = sorted({(h or "", p or "", min(v for a, b, v in rules if (a, b or "") == (h, p or ""))) for h, p, _ in rules})
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = host.lower()
        fits = [r for r in clean if (r[0] == "" or host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
        want = (host, path, best[0] + best[1] if best else None, best[2] if best else "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == want, u
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in urlrules.judge(pages, none, "block").collect()} == {"block"}
    assert urlrules.judge(pages.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).isEmpty()


def test_secrets_of_edge_rows(spark):
    rows = [(1, "é token: abcdefgh12 x"), (2, None), (3, ""), (4, "f" * 100_000), (5, "AKIA" + "A1" * 6), (5, "AKIA"), (None, "secret=short")]
    got = {(r.doc_id, tuple((s.start, s.end, s.kind) for s in r.spans)) for r in secretscan.secrets(documents(spark, rows)).collect()}
    assert got == {(1, ((2, 19, "assign"),)), (2, ()), (3, ()), (4, ((0, 100_000, "hex"),)), (5, ((0, 16, "access"),)), (5, ()), (None, ())}
    assert secretscan.secrets(documents(spark, [])).isEmpty()


def test_nearest_equal_brute_force(spark):
    draw = np.random.default_rng(9)
    vectors = draw.standard_normal((300, 16))
    vectors[100:180] = vectors[0]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    rows += [(500, None, ""), (550, [0.0] * 16, ""), (600, [float("nan")] + [1.0] * 15, ""), (650, [None] + [1.0] * 15, ""), (700, [1.0, 2.0], ""), (None, [1.0] * 16, ""), (750, [float("inf")] * 16, "")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(4)
    got = {}
    for r in onebit.nearest(table, F.col("vec_id") % 50 == 0, 5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    norm = np.sqrt((vectors * vectors).sum(1))
    assert sorted(got) == list(range(0, 300, 50))
    for q, found in got.items():
        exact = (vectors * vectors[q]).sum(1) / (norm * norm[q])
        exact[q] = -2
        assert [v for v, _ in found] == np.lexsort((np.arange(300), -exact))[:5].tolist()
        assert all(s == pytest.approx(exact[v], abs=1e-12) for v, s in found)
    assert onebit.nearest(table.limit(0), F.col("vec_id") % 50 == 0).isEmpty()


def test_nearest_beside_repeated_query_rows(spark):
    same, far = [1.0, 2.0, 3.0], [3.0, -1.0, 2.0]
    rows = [(0, same)] * 3 + [(i, same) for i in range(1, 11)] + [(20, far), (21, far)] + [(30, [-1.0, 0.5, 0.1])] * 7
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    found = onebit.nearest(table, F.col("vec_id").isin(0, 30), 5).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in found if r.query_id == 0] == [1, 2, 3, 4, 5]
    assert [r.vec_id for r in found if r.query_id == 30] == [0, 0, 0, 1, 2]


def test_nearest_fetches_a_block_after_the_last_is_written(spark, monkeypatch):
    draw = np.random.default_rng(10)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(draw.standard_normal((60, 8)))], "vec_id long, embedding array<double>")
    is_query = F.col("vec_id") % 5 == 0
    whole = onebit.nearest(table, is_query, 3).orderBy("query_id", "rank").collect()
    steps, fetch, write = [], type(table).toArrow, type(table.write).parquet
    monkeypatch.setattr(type(table), "toArrow", lambda self: steps.append("fetch") or fetch(self))
    monkeypatch.setattr(type(table.write), "parquet", lambda self, *a, **b: steps.append("write") or write(self, *a, **b))
    monkeypatch.setattr(onebit, "QUERY_BLOCK", 5)
    found = onebit.nearest(table, is_query, 3).orderBy("query_id", "rank").collect()
    assert found == whole and len(found) == 36
    steps = steps[steps.index("fetch") :]
    assert steps.count("fetch") > 1 and all(a != b for a, b in zip(steps, steps[1:])) and steps[-1] == "write"


def test_contaminated_documents(spark):
    draw = random.Random(10)
    items = [(1, sentence(draw, 30)), (2, sentence(draw, 20)), (3, None), (4, ""), (1, None)]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    clean = sentence(draw, 50)
    rows = [(1, f"{clean} {items[0][1].upper()} {clean}"), (2, clean), (3, None), (4, ""), (5, f"{items[0][1]} {items[1][1]}"), (None, items[1][1]), (6, clean * 500 + items[0][1]), (1, clean)]
    found = decontam.contaminated(documents(spark, rows), benchmark)
    assert sorted((r.doc_id or -1, r.item_id, r.distance) for r in found.collect()) == [(-1, 2, 0), (1, 1, 0), (5, 1, 0), (5, 2, 0), (6, 1, 0)]
    kept = decontam.decontaminate(documents(spark, rows), benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4] and kept.columns == documents(spark, rows).columns
    assert decontam.contaminated(documents(spark, []), benchmark).isEmpty()
    assert decontam.contaminated(documents(spark, rows), benchmark.limit(0)).isEmpty()
    decontam_bytes, decontam.BLOCK_BYTES = decontam.BLOCK_BYTES, 100
    try:  # several blocks of items
        assert decontam.contaminated(documents(spark, rows), benchmark).count() == 5
    finally:
        decontam.BLOCK_BYTES = decontam_bytes


def test_stages_keep_columns_of_any_name(spark):
    names = ["__id", "__node", "__rate", "__lower", "__turn", "__topic", "row", "id", "node", "turn", "rate", "topic", "worded", "probability", "n_tokens", "lower"]
    draw = random.Random(7)
    rows = [(i, sentence(draw, 30), "en", f"s{i % 2}", *[f"{n} {i}" for n in names]) for i in range(12)]
    schema = ", ".join(["doc_id long, text string, lang string, source string", *[f"`{n}` string" for n in names]])
    docs = spark.createDataFrame([*rows, rows[0]], schema)
    kept = probminhash.deduplicated(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == rows
    drawn = raking.mixed_rows(docs, {"source": 1.0}, size=1.0)
    assert drawn.columns == docs.columns and {tuple(r) for r in drawn.collect()} <= set(rows)
    scored = toxicity.score(docs, toxicity.fit([], []), "toxic_score")
    assert scored.columns == [*docs.columns, "toxic_score"] and sorted(tuple(r)[:-1] for r in scored.collect()) == sorted([*rows, rows[0]])
    again = toxicity.score(scored, toxicity.fit([], []), "toxic_score")
    assert again.columns == scored.columns
    items = spark.createDataFrame([(0, rows[3][1])], "item_id long, text string")
    assert sorted(map(tuple, decontam.decontaminate(kept, items).collect())) == [r for r in rows if r[0] != 3]
