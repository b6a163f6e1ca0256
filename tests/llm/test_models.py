"""Operators without a contract: against libraries, brute force and held-out rows."""

import itertools
import math
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from fitloom.llm import bpe, chat, decontam, graph, substring, toxicity, unigram

SF = "/root/testdata/sf0.01"


def test_transducer_equals_library_for_any_chunks(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    m, t = bpe.model(path), Tokenizer.from_file(path)
    enc, dec, rnd = bpe.Encoder(m), bpe.Decoder(m), random.Random(1)
    bits = ["a", "e", "th", "ing", " ", "  ", "\n", "'s", "'", "'ll", "1", "é", "　", "-", "----", "<|endoftext|>", "漢", "😀", "\x1c", "\x85", "."]
    for _ in range(400):
        s = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40)))
        monkeypatch.setattr(bpe, "CHUNK", rnd.choice([1, 2, 5, 64, 65536]))
        ids = t.encode(s, add_special_tokens=False).ids
        assert enc.encode(s).tolist() == ids
        assert dec.decode(np.array(ids, np.int64)) == t.decode(ids, skip_special_tokens=False)


def test_lookahead_is_enough():
    m = bpe.model(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = random.Random(2)
    for k in range(60):
        s = "".join(rnd.choice("aeth-= ÃÂ"[: 3 + k % 6]) for _ in range(6000)).encode()
        pipe, out = bpe.Transducer(m), []
        at = 0
        while at < len(s):
            step = rnd.randint(1, 700)
            out += pipe.feed(s[at : at + step])
            assert len(pipe.carry) < 2 * m.lookahead + 700
            at += step
        assert out + pipe.finish() == m.merge(s)


def test_bytes_to_text_equals_lossy_decoding():
    rnd = random.Random(3)
    for _ in range(500):
        data = bytes(rnd.choice([0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xED, 0xA0, 0xC0, 0xFF, 0xF4, 0x90]) for _ in range(12))
        machine = bpe.ByteToText()
        assert "".join(machine.feed(data[i : i + 3]) for i in range(0, 12, 3)) + machine.finish() == data.decode("utf-8", "replace")


def test_counts_equal_library():
    vocab, unk = unigram.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    t = Tokenizer(models.Unigram(vocab, unk_id=unk, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    c, rnd = unigram.Counter(vocab, unk), random.Random(4)
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' LIMIT 200").fetchall()]
    texts += ["".join(rnd.choice(["a", "th", "é", " ", "  ", "\n", "漢字", "😀", "▁", "<unk>", "<0x41>", "Ω"]) for _ in range(15)) for _ in range(500)]
    assert [c.text(x)[0] for x in texts] == [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


#: What may follow what, and what repairs cost, stated here once more.
FOLLOWS = {None: {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user"}}
NAMES = ["system", "user", "assistant"]


def empties(before, role):
    """Fewest empty turns between what came last and a turn of this role."""
    if role in FOLLOWS[before]:
        return 0
    return next(n for n in (1, 2, 3) for mid in itertools.product(NAMES, repeat=n) if all(b in FOLLOWS[a] for a, b in zip((before, *mid), (*mid, role), strict=True))) if role != "system" else 99


def brute_repair(roles):
    """Least cost over every choice of role and merge of every turn."""
    best = 10**6
    for made in itertools.product(NAMES, repeat=len(roles)):
        for merged in itertools.product((False, True), repeat=len(roles)):
            cost, last = 0, None
            for given, role, merge in zip(roles, made, merged, strict=True):
                cost += 0 if given is not None and role == NAMES[given] else 3
                if merge:
                    cost += 1 if role == last else 99
                else:
                    cost += 2 * empties(last, role)
                    last = role
            best = min(best, cost + (0 if last == "assistant" else 2 if last == "user" else 4))
    return best


def legal(roles):
    state = 0
    for r in roles:
        if r not in chat.LEGAL[state]:
            return False
        state = r + 1
    return state == 3


def repaired_in_parts(parts):
    """Choices for a conversation cut into parts, and the state after it."""
    costs, entries = chat.START, []
    for p in parts:
        entries.append(costs)
        costs = chat.after(costs, chat.matrix(p))
    state = end = chat.last_state(costs)
    out = []
    for p, entry in zip(parts[::-1], entries[::-1], strict=True):
        out = chat.repair(p, entry, state) + out
        state = chat.back(p, entry)[state]
    assert state == chat.FRESH
    return out, end


def test_repair_is_legal_and_cheapest_and_segments_dont_matter():
    for n in range(1, 6):
        for roles in itertools.product([0, 1, 2, None], repeat=n):
            whole, end = repaired_in_parts([list(roles)])
            for cut in range(1, n):
                assert repaired_in_parts([list(roles[:cut]), list(roles[cut:])]) == (whole, end)
            out, cost = [], 0
            for (action, fill, r, own), given in zip(whole, roles, strict=True):
                out += list(fill)
                by = chat.INSERT * len(fill) + (0 if r == given else chat.UNKNOWN if given is None else chat.RELABEL)
                if action == "merge":
                    by += chat.MERGE
                    assert out[-1] == r
                else:
                    out.append(r)
                assert own == by
                cost += by
            close = chat.FILL[end, 3][1]
            assert legal(out + list(close))
            if n < 5:
                assert cost + chat.INSERT * len(close) == brute_repair(roles)


def test_repair_of_random_cuts():
    rnd = random.Random(11)
    for _ in range(300):
        roles = [rnd.choice([0, 1, 2, None]) for _ in range(rnd.randint(2, 60))]
        cuts = sorted({0, len(roles), *(rnd.randrange(len(roles)) for _ in range(4))})
        assert repaired_in_parts([roles[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]) == repaired_in_parts([roles])


def test_repair_of_odd_tables(spark, tmp_path, monkeypatch):
    """The registered query: nulls, empties, a long text, ties, repeats, clashing columns, no rows; the same rows for any cuts."""
    from fitloom.llm import queries

    rnd = random.Random(12)
    data = [(conv, rnd.randrange(40), rnd.choice(["user", "USER ", "assistant", "system", "tool", None, ""]), rnd.choice(["a", "", None, "b c"])) for conv in (1, 1, 1, 2, 3, None, None, 9) for _ in range(30)]
    data += [data[0]] * 5 + [(7, None, "user", "y " * 600000), (7, 1, "assistant", "z"), (8, 0, "assistant", None)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS place", "'x' AS action", "2 AS segment", "true AS last", "3 AS run")
    df.repartition(3).write.parquet(f"{tmp_path}/a/conversations.parquet")
    df.limit(0).write.parquet(f"{tmp_path}/b/conversations.parquet")
    run = queries.queries()["op3_chat_repair"]
    seen = []
    for size, partitions in ((2, 4), (7, 1), (512, 4), (512, 23)):
        monkeypatch.setattr(chat, "SEGMENT", size)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        seen.append(sorted(map(repr, run(spark, f"{tmp_path}/a").collect())))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert len(seen[0]) == len(data) and seen.count(seen[0]) == 4
    got = run(spark, f"{tmp_path}/a").collect()
    for conv in {r["conv_id"] for r in got}:
        turns = sorted((r for r in got if r["conv_id"] == conv), key=lambda r: r["place"])
        assert [r["place"] for r in turns] == list(range(len(turns)))
        roles = [chat.role_of(r["role"]) for r in turns]
        assert legal([chat.ROLES.index(x.partition("|>")[0]) for x in "".join(r["rendered"] for r in turns).split("<|")[1:] if not x.startswith("end")])
        assert sum(r["cost"] for r in turns) >= 0 and len(roles) == len(turns)
    assert run(spark, f"{tmp_path}/b").count() == 0


def test_long_conversation_in_segments(spark, monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT", 7)
    data = [(1, k, ["user", "user", "assistant", "tool", None][k % 5], f"t{k}") for k in range(100)] + [(2, 0, "assistant", None), (None, 0, "user", "x")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = chat.repaired(df).orderBy("conv_id", "segment", "place").collect()
    assert len(got) == 102
    for conv in (1, 2, None):
        text = "".join(r["rendered"] for r in got if r["conv_id"] == conv)
        turns = [x.partition("|>")[0] for x in text.split("<|")[1:]]
        assert legal([chat.ROLES.index(t) for t in turns if t != "end"]) and turns[1::2] == ["end"] * (len(turns) // 2)
    assert chat.repaired(df.limit(0)).count() == 0


def test_toxicity_on_held_out_rows():
    rows = duckdb.sql(f"SELECT d.text, toxic FROM '/root/testdata/sf0.1/documents.parquet' d JOIN '/root/testdata/sf0.1/labels.parquet' l USING (doc_id) ORDER BY hash(d.doc_id)").fetchall()
    half = len(rows) // 2
    train, test = rows[:half], rows[half:]
    sets = toxicity.runs([t.encode() for t, _ in train])
    copies = {i for i, j in toxicity.suspects(toxicity.sketch(sets)) if toxicity.alike(sets[i], sets[j])}
    keep = [i for i in range(len(train)) if i not in copies]
    row, f, v, _ = toxicity.features([train[i][0].encode() for i in keep])
    y = np.array([train[i][1] for i in keep])
    model = toxicity.fit(row, f, v, toxicity.severity(row, f, v, y))
    assert (np.diff(model.thresholds) > 0).all()
    row, f, v, _ = toxicity.features([t.encode() for t, _ in test], model.names)
    p = model.above(np.bincount(row, model.weights[f] * v, len(test)))
    truth = np.array([x[1] for x in test])
    assert (p[:, 0] >= p[:, 1]).all()
    assert (p[truth == 0, 0] < 0.4).mean() > 0.99 and (p[truth == 1, 0] >= 0.4).mean() > 0.85


def test_only_confirmed_copies_leave_training():
    """Rows left out have an earlier row at 0.8, and hardly a row that has one stays, against all pairs."""
    rnd = random.Random(5)
    texts = []
    for _ in range(60):
        words = [f"w{rnd.randrange(400)}" for _ in range(rnd.choice((1, 2, 3, 40, 90)))]
        texts.append(words)
        texts += [[f"x{rnd.randrange(400)}" if rnd.random() < rate else w for w in words] for rate in (0.0, 0.01, 0.03, 0.1, 0.3)]
    rnd.shuffle(texts)
    raw = [" ".join(w).encode() for w in texts] + [b"", b" "]
    plain = [{tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set() for w in (r.split() for r in raw)]
    near = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    want = {i for i in range(len(raw)) if any(near(plain[i], plain[j]) for j in range(i))}
    sets = toxicity.runs(raw)
    assert [len(x) for x in sets] == [len(x) for x in plain]
    got = {i for i, j in toxicity.suspects(toxicity.sketch(sets)) if toxicity.alike(sets[i], sets[j])}
    assert got <= want and len(got) > 0.95 * len(want) > 50


def test_fit_and_prediction_against_plain_sums(spark):
    """Severity and grade of predict() from each text's own counts; fit() against the likelihood worked out row by row."""
    rnd = random.Random(6)
    words = [f"v{i}" for i in range(12)]
    data = [(k, " ".join(rnd.choices(words, k=rnd.randint(0, 30)))) for k in range(200)] + [(200, None), (201, "")]
    raw = [(t or "").encode() for _, t in data]
    row, f, v, _ = toxicity.features(raw)
    # without some grades at random no finite weights would be the likeliest
    y = np.array([rnd.randrange(3) if rnd.random() < 0.25 else min(2, (t or "").count("v1 ") // 2) for _, t in data])
    m = toxicity.fit(row, f, v, y)
    assert len(m.names) and (np.diff(m.thresholds) > 0).all()
    weight = dict(zip(m.names.tolist(), m.weights.tolist(), strict=True))
    score = [sum(weight.get(int(a), 0.0) * b for a, b in zip(f[row == i], v[row == i], strict=True)) for i in range(len(data))]

    def loss(shift):
        out = 0.0
        for s, g in zip(score, y.tolist(), strict=True):
            above = [1.0, *(1 / (1 + math.exp(t + shift - s)) for t in m.thresholds), 0.0]
            out -= math.log(above[g] - above[g + 1])
        return out

    assert loss(0.0) < min(loss(0.2), loss(-0.2))
    got = {r["doc_id"]: r for r in toxicity.predict(spark.createDataFrame(data, "doc_id long, text string"), m).collect()}
    for i, s in enumerate(score):
        above = [1 / (1 + math.exp(t - s)) for t in m.thresholds]
        each = [1 - above[0], above[0] - above[1], above[1]]
        r = got[i]
        assert abs(r["severity"] - sum(above)) < 1e-9 and abs(r["p_toxic"] - above[0]) < 1e-9 and r["kept"] == (above[0] < 0.4)
        assert each[r["grade"]] > max(each) - 1e-9


def test_white_space_stays_where_nothing_is_cut(spark):
    text = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(1, text), (2, f" a\tb\n\n{text}\n c  d\n"), (3, " x \n y\t"), (4, None), (5, " \n"), (6, f"\n{text} "), (7, f"{text}\n e")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in substring.remove_repeats(df, 13, spaces=True).collect()}
    assert got == {1: text, 2: " a\tb\n c  d\n", 3: " x \n y\t", 4: "", 5: " \n", 6: "", 7: "\n e"}
    joined = {r["doc_id"]: r["text"] for r in substring.remove_repeats(df, 13).collect()}
    assert joined == {k: " ".join(t.split()) for k, t in got.items()}


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "")], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r["kept"] for r in toxicity.predict(docs, model).collect()] == [True] * 3


def test_planted_benchmark_items(spark):
    item = "Anna bought 12 apples for 30 dollars and gave three to her brother Tom before the train to Paris left at noon today."
    other = "A completely different question about the colour of leaves in autumn and why they fall down from old trees."
    again = item.replace("Anna", "Maria").replace("12", "45").replace("30", "77").replace("Tom", "Jan").replace("Paris", "Oslo")
    mixed = item.replace("three to her brother Tom", "three to her brother Anna")
    texts = [item, "Before. " + again + " After it.", mixed, other[:40], None, "", "short", f"x y z {other} {again}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, other), (3, None), (None, item), (4, " ")], "item_id long, text string")
    want = {0: [1], 1: [1], 3: [], 4: [], 5: [], 6: [], 7: [1, 2]}
    for found in (decontam.contaminated(docs, bench), decontam._shuffled(docs, bench.where("item_id is not null and trim(text) <> ''").distinct(), decontam.SHARE)):
        got = {r["doc_id"]: r["items"] for r in found.collect()}
        assert {k: got[k] for k in want} == want
    assert decontam.contaminated(docs, bench.limit(0)).where("kept").count() == len(texts)


def test_verbatim_items_are_found_and_nothing_else(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    items = [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    want = {d for d, t in docs if any(i in t for i in items)}
    found = decontam.contaminated(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert {r["doc_id"] for r in found.where("not kept").collect()} == want


def test_components_of_random_graphs(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r["u"]: r["v"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got.get(x, x) == find(x) for x in root)
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_automaton_windows():
    rnd = random.Random(6)
    refs = [[rnd.randrange(3) for _ in range(30)] for _ in range(6)]
    auto = substring.SuffixAutomaton()
    for k, r in enumerate(refs):
        auto.add(r, k)
    auto.close()
    for _ in range(40):
        q = [rnd.randrange(3) for _ in range(25)]
        want = [next((k for k, r in enumerate(refs) if any(r[j : j + 5] == q[i : i + 5] for j in range(26))), -1) for i in range(21)]
        assert auto.windows(q, 5) == want


def test_pipeline_against_plain_stages(spark):
    """run() on a small table: the stages one after another in plain Python, but for the fitted model."""
    import brute
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    clean = sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_toxic(spark, docs, sf).collect())
    first = {d: c for d, _, c, _ in brute.op5(clean, 5, 80)}
    kept = [(d, t) for d, t in clean if first[d] == d]
    seen, cut = {}, []
    words, text_of = {d: brute.words(t) for d, t in kept}, {d: t or "" for d, t in kept}
    for d in sorted(words):
        for i in range(len(words[d]) - 12):
            seen.setdefault(tuple(words[d][i : i + 13]), d)
    for d, w in words.items():
        gone = {j for i in range(len(w) - 12) if seen[tuple(w[i : i + 13])] < d for j in range(i, i + 13)}
        if not w or len(gone) < len(w):
            pieces = re.findall(r"[ \t-\r]*[^ \t-\r]+", text_of[d])
            tail = text_of[d][sum(map(len, pieces)) :]
            cut.append((d, "".join(x for j, x in enumerate(pieces) if j not in gone) + (tail if len(w) - 1 not in gone else "")))
    items = [" ".join(r[0].split()) for r in duckdb.sql(f"SELECT text FROM '{sf}/benchmark.parquet'").fetchall()]
    assert any("\n" in t for _, t in cut)
    want = brute.op2([(d, t) for d, t in cut if not any(i in " ".join(t.split()) for i in items)])
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, sf).collect())
    assert got == want


CHOICES = "Which city is the capital of France and lies on the Seine\nA) London\nB) Paris\nC) Rome\nD) Madrid"


def both_ways(spark, texts, items):
    """Items that each text holds, which the broadcast and the shuffled join agree on."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    one, two = ({r["doc_id"]: r["items"] for r in f(docs, bench, decontam.SHARE).collect()} for f in (decontam.contaminated, decontam._shuffled))
    assert one == two
    return [one[k] for k in range(len(texts))]


def test_items_without_their_line_breaks(spark):
    short = "Name the city\nParis"
    texts = [CHOICES, " ".join(CHOICES.split()), "some text before it " + " ".join(CHOICES.split()) + " Answer", CHOICES.replace("\n", "\n\n"), " ".join(short.split()), "Visit the city Bern", "A) London B) Paris C) Rome D) Madrid"]
    assert both_ways(spark, texts, [CHOICES, short]) == [[0], [0], [0], [0], [1], [], []]
    lists = "Bern Oslo Rome Wien Riga Lima Kiel Cork Bonn"
    assert both_ways(spark, [lists, "Some " + " ".join(x.title() for x in "ab cd ef gh ij kl mn op".split())], ["Paris " + lists]) == [[0], []]


def test_pipeline_drops_items_whose_lines_stage_three_joined(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, CHOICES)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, "some own words come before\n" + CHOICES + "\nand other words after it"), (2, "a clean text about\nnothing that is asked")], "doc_id long, text string")
    cut = corpus_pipeline.cut_repeats(spark, docs, str(tmp_path))
    assert [r["doc_id"] for r in corpus_pipeline.drop_leaks(spark, cut, str(tmp_path)).collect()] == [2]


def test_items_with_other_names_numbers_and_lengths(spark):
    apples = "Alice has 3 apples. Bob has 5 apples and gives Alice 2 of them. Carol takes 1 apple from Alice. How many apples does Alice have now?"
    bus = "A bus with twenty five people leaves New York at noon and stops in Boston where 4 people get off. How many people are on the bus when it leaves Boston for New York again?"
    other = apples.replace("Alice", "Maria").replace("Bob", "Jan").replace("Carol", "Eve").replace("3", "13").replace("5", "17").replace(" 2 ", " 4 ").replace(" 1 ", " 6 ")
    texts = [
        other,
        "Word Problem " + other,  # a heading grows together with the first name
        apples.replace("Alice", "Mary Ann Smith").replace(" 3 ", " thirty one "),
        apples.replace("3", "7").replace("5", "7"),  # two values become one
        bus.replace("twenty five", "31").replace("New York", "Oslo"),
        bus.replace("Boston", "Bad Homburg").replace(" 4 ", " one hundred "),
        apples.replace("Alice", "Maria", 2).replace("Alice", "Olga"),  # one name becomes two
        "Alice Bob Carol 3 5 2 1 apples",
        bus.replace("people", "sheep").replace("leaves", "finds"),
    ]
    texts += [" ".join(t.split()[::-1]) for t in (apples, bus)] + ["Paris, London and Rome. " * 9, "", "WHAT IS THIS ALL ABOUT " * 9]
    want = [[0], [0], [0], [0], [1], [1]]
    assert both_ways(spark, texts, [apples, bus]) == want + [[]] * (len(texts) - len(want))
    assert both_ways(spark, ["IS THIS", "Oslo And So On For Ever"], ["WHAT IS THE CAPITAL OF FRANCE"]) == [[], []]


def test_slots_alone_are_no_evidence(spark):
    """Numbers, names and short items match their own values only."""
    numbers = "3 7 12 19 44"
    texts = ["row 901 22 388 5 61 end", "row 3 7 12 19 44 end", "oh yes it is", "Yes", "45 apples", "12 apples", "we had 12 apples", "1 2 3 4 5 6 7 8 9 10 " * 50, None, "", "12 apples"]
    assert both_ways(spark, texts, [numbers, "yes", "12 apples"]) == [[], [0], [], [1], [], [2], [], [], [], [], [2]]


def brute_items(text, item, n=5, share=0.8):
    """Whether one alignment of lower-cased words has `share` of the item's windows verbatim."""
    d, i = text.lower().split(), item.lower().split()
    if len(i) < n:
        return d == i
    total = len(i) - n + 1
    return any(sum(0 <= s + j and d[s + j : s + j + n] == i[j : j + n] for j in range(total)) >= share * total for s in range(-len(i), len(d)))


def test_partial_items_against_brute_force(spark):
    """Plain lower-case words: held is what brute force over all alignments says, for items cut and joined at random."""
    rnd = random.Random(9)
    word = lambda: rnd.choice("ab cd ef gh ij kl mn op".split())
    items = [" ".join(word() for _ in range(rnd.randint(1, 14))) for _ in range(30)]
    texts = []
    for _ in range(120):
        parts = [items[rnd.randrange(30)].split() for _ in range(rnd.randint(1, 3))]
        texts.append(" ".join(w for p in parts for w in p[rnd.randint(0, 2) : len(p) - rnd.randint(0, 2)]))
    assert both_ways(spark, texts, items) == [[k for k, i in enumerate(items) if brute_items(t, i)] for t in texts]


def test_decontamination_of_odd_tables(spark, tmp_path):
    """The registered query with nulls, repeats, a long text, clashing columns, and without rows."""
    from fitloom.llm import queries

    item = "the quick brown fox jumps over the lazy dog near the old river bank"
    data = [(1, item), (1, item), (None, item), (2, None), (3, ""), (4, "x y " * 300000 + item), (5, "nothing of it here at all")]
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 AS items", "'a' AS kept", "2 AS coverage", "3 AS key", "4 AS view")
    bench = spark.createDataFrame([(7, item), (7, item), (8, None)], "item_id long, text string").selectExpr("*", "1 AS doc_id")
    docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    bench.write.parquet(f"{tmp_path}/a/benchmark.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    bench.limit(0).write.parquet(f"{tmp_path}/b/benchmark.parquet")
    run = queries.queries()["op8_decontamination"]
    got = sorted((r["doc_id"] or 99, tuple(r["items"]), r["kept"]) for r in run(spark, f"{tmp_path}/a").collect())
    assert got == [(1, (7,), False), (1, (7,), False), (2, (), True), (3, (), True), (4, (7,), False), (5, (), True), (99, (7,), False)]
    assert run(spark, f"{tmp_path}/b").count() == 0


def test_merged_slots_keep_to_their_texts():
    t = decontam.Template([b"we saw New York", b"Old Town, New Town and 2 3 4 km", b"", b"Oslo"])
    v = t.views[2]
    assert v.size.tolist() == [1, 1, 2, 2, 2, 1, 3, 1, 1] and v.bounds.tolist() == [0, 3, 8, 8, 9]
    assert v.value[3] != v.value[4] and decontam.Template([b"York New"]).views[2].value[0] != v.value[2]
