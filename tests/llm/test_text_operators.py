import random

import pytest
from pyspark.sql import functions as F

from tidewater.llm import mixing, packing, pii, queries
from tidewater.llm.pii_field import Field, Graph
from tidewater.llm.text import TOKENIZER, token_counts

FIELD = Field.load(str(pii.WEIGHTS))


# ---- token counts ------------------------------------------------------------------------------


def test_counts_by_the_tokenizer(spark):
    from tokenizers import Tokenizer

    texts = [None, "", " ", "Hello world", "<|endoftext|>", "ä😀" * 50, "x" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    got = {r.id: r.n_tokens for r in token_counts(df, ["id"], "text").collect()}
    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    assert got == {i: len(t.encode(x or "", add_special_tokens=False).ids) for i, x in enumerate(texts)}


# ---- packing -----------------------------------------------------------------------------------


def test_a_full_item_closes_no_bin():
    lane = packing.BestFit(100, 2)
    assert [lane.place(n) for n in (60, 50, 100, 40)] == [(0, 0), (1, 0), (2, 0), (0, 60)]


def test_best_fit_against_plain_search():
    rng = random.Random(1)
    for limit in (1, 3, 8):
        lane, open_, made = packing.BestFit(100, limit), [], 0  # [bin, free], oldest first
        for _ in range(400):
            size = rng.randrange(1, 101)
            fits = [b for b in open_ if b[1] >= size]
            if fits:
                best = min(fits, key=lambda b: b[1])
            else:
                if len(open_) == limit and size < 100:
                    open_.remove(min(open_, key=lambda b: b[1]))
                best = [made, 100]
                made += 1
            want = (best[0], 100 - best[1])
            if best in open_:
                open_.remove(best)
            best[1] -= size
            if best[1]:
                open_.append(best)
            assert lane.place(size) == want


@pytest.mark.parametrize("lanes", [1, 4096])
def test_packed_texts_are_whole_and_fit(spark, lanes):
    rng = random.Random(2)
    rows = [(i, rng.choice([0, None, *range(1, 60), 250])) for i in range(300)] + [(None, 5), (7, 11), (7, 11)]
    items = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint")
    kinds = spark.createDataFrame([("small", 50), ("large", 400)], "container_name string, capacity_tokens int")
    out = packing.pack(items, kinds, open_bins=4, lane_containers=lanes)
    got = out.collect()
    for name, capacity in (("small", 50), ("large", 400)):
        mine = [r for r in got if r.container_name == name]
        assert sorted((r.doc_id, r.n_tokens) for r in mine if r.piece_no == 0 and r.n_tokens < capacity or capacity == 400) == sorted((d, n) for d, n in rows if d is not None and n and n < capacity)
        assert sum(r.n_tokens for r in mine) == sum(n for d, n in rows if d is not None and n)
        bins = {}
        for r in mine:
            bins.setdefault(r.bin_id, []).append((r.offset_tokens, r.n_tokens))
        for parts in bins.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at <= capacity
    assert out.where("piece_no > 0").select("n_tokens").count() == sum(-(-n // 50) - 1 for d, n in rows if d is not None and n)
    assert {r.container_name for r in packing.fill_report(out, kinds).collect()} == {"small", "large"}
    assert packing.pack(items.limit(0), kinds).count() == 0
    with pytest.raises(ValueError):
        packing.pack(items, spark.createDataFrame([("x", 0)], "container_name string, capacity_tokens int"))


# ---- mixing ------------------------------------------------------------------------------------


def test_shortages_go_to_siblings_before_ancestors():
    root = mixing.tree([("d1", "en", "a", 1, 10), ("d1", "en", "b", 1, 1000), ("d1", "de", "a", 1, 1000), ("d2", "en", "c", 3, 1000)])
    root.assign(600)
    leaf = lambda d, l, s: root.children[d].children[l].children[s].budget  # noqa: E731, E741
    assert (leaf("d1", "en", "a"), leaf("d1", "en", "b"), leaf("d1", "de", "a"), leaf("d2", "en", "c")) == (10, 190, 100, 300)
    root = mixing.tree([("d1", "en", "a", 1, 10), ("d1", "de", "b", 1, 20), ("d2", "en", "c", 2, 1000)])
    root.assign(400)
    assert root.children["d2"].budget == 370


def docs(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["HOT", "HOT", "B", "C", None, "OTHER"]), rng.choice(["EN", "DE"]), rng.choice([0, *range(1, 40)])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_tokens bigint")


def test_shares_and_repeats(spark):
    rows, sized = docs(spark)
    targets = spark.createDataFrame([("m", " hot ", 5.0, 2), ("m", "b", 3.0, 1), ("m", "C", 2.0, 3), ("m", "absent", 4.0, 9), ("m", None, 1.0, 1), ("n", "b", 1.0, 0)], "mix_name string, source string, target_weight double, max_repeats int")
    the_plan = mixing.plan(sized, targets)
    chosen = mixing.select(sized, the_plan, seed=4)
    got = chosen.collect()
    most = {"HOT": 2, "B": 1, "C": 3}
    assert all(1 <= r.copies <= most[r.source] and r.mix_name == "m" for r in got)
    total = sum(r.n_tokens * r.copies for r in got)
    for source, weight in (("HOT", 0.5), ("B", 0.3), ("C", 0.2)):
        share = sum(r.n_tokens * r.copies for r in got if r.source == source) / total
        assert abs(share - weight) < 40 / total + 0.01
    report = {(r.mix_name, r.source): r for r in mixing.shares(chosen, the_plan).collect()}
    assert report["m", "ABSENT"].actual_share == 0 and abs(sum(r.actual_share for (m, _), r in report.items() if m == "m") - 1) < 1e-9
    again = mixing.select(sized.repartition(7), mixing.plan(sized, targets), seed=4).collect()
    assert sorted(again) == sorted(got)
    full = mixing.select(sized, mixing.plan(sized, targets, 10**9)).groupBy("source").agg(F.min("copies").alias("a"), F.max("copies").alias("b")).collect()
    assert {(r.source, r.a, r.b) for r in full} == {(s, n, n) for s, n in most.items()}
    assert mixing.select(sized.limit(0), mixing.plan(sized.limit(0), targets)).count() == 0
    del rows


def test_queries_make_up_for_scarce_sources(spark, folder):
    rows = queries.p8_mix_documents(spark, folder).collect()
    report = queries.p8_mix_shares(spark, folder).collect()
    there = queries._sized(spark, folder).agg(F.sum("n_tokens")).first()[0]
    for mix in {r.mix_name for r in report}:
        usable = sum(r.usable_tokens for r in report if r.mix_name == mix)
        took = sum(r.n_tokens * r.copies for r in rows if r.mix_name == mix)
        assert took == sum(r.tokens for r in report if r.mix_name == mix)
        assert 0.8 * min(there, usable) < took <= usable
    short = [r for r in report if r.tokens == r.usable_tokens > 0]
    assert short and any(r.actual_share > r.target_share + 0.01 for r in report)


# ---- personal information ----------------------------------------------------------------------

CASES = [
    ("Please write to ana.k_9@mail.korreo.example instead.", [("EMAIL", "ana.k_9@mail.korreo.example")]),
    ("write to rik [at] inboxa [dot] example, or tim(at)postly.test", [("EMAIL", "rik [at] inboxa [dot] example"), ("EMAIL", "tim(at)postly.test")]),
    ('<a href="mailto:h.x+shop@lettre.test">x</a>', [("EMAIL", "h.x+shop@lettre.test")]),
    ("Reply went to the queue returns@ by mistake; price was 3@$4.10", []),
    ("You can reach me at +49 30 23125 053, not ext. 12.", [("PHONE", "+49 30 23125 053")]),
    ("Call back (605) 555-0104 or 07700 900 438 ext. 3", [("PHONE", "(605) 555-0104"), ("PHONE", "07700 900 438")]),
    ("Rappeler 06.39.98.49.48 ou 0034 553803603", [("PHONE", "06.39.98.49.48"), ("PHONE", "0034 553803603")]),
    ("Loyalty card LL 9198 1707 7399 and order O0000002255, TRK385907783293.", []),
    ("SSN on the credit form: 959-05-7588.", [("ID_NUMBER", "959-05-7588")]),
    ("Steuer-ID 08 141 445 869 liegt vor. DNI 12345678-Z presentado en tienda.", [("ID_NUMBER", "08 141 445 869"), ("ID_NUMBER", "12345678-Z")]),
    ("Ship the replacement to 12B Whistler Rd, Apt 4B, 49238 Eastvale.", [("ADDRESS", "12B Whistler Rd, Apt 4B")]),
    ("Lieferung bitte an Mühlstr. 19a. Livrer au 34, quai du Lavoir.", [("ADDRESS", "Mühlstr. 19a"), ("ADDRESS", "34, quai du Lavoir")]),
    ("Enviar a Avenida del Trigo, 76, 2.º izq..", [("ADDRESS", "Avenida del Trigo, 76, 2.º izq.")]),
    ("Frau Lundsen wohnt jetzt Hinterm Speicher 114. Livrer au 9 rue du vieux moulin.", [("NAME", "Lundsen"), ("ADDRESS", "Hinterm Speicher 114"), ("ADDRESS", "9 rue du vieux moulin")]),
    ("Ship it to 48333 Lindau am Wehr 18 of 9 labels", []),
    ("Main Street traffic slowed every delivery.", []),
    ("Pick up by Björn Pellert's neighbour was refused.", [("NAME", "Björn Pellert")]),
    ("Contact: L. Ulmard and Mark T. Ildrimore; Mme Gramandt.", [("NAME", "L. Ulmard"), ("NAME", "Mark T. Ildrimore"), ("NAME", "Gramandt")]),
    ("Mark the shelf, then hope June is quieter.", []),
    ("Driver left it with June from next door, order O0000002949.", [("NAME", "June")]),
]


@pytest.mark.parametrize(("text", "want"), CASES)
def test_found_in_text(text, want):
    assert [(k, text[s:e]) for k, s, e in pii.occurrences(FIELD, text)] == want


def test_long_texts_nulls_and_round_trip(spark):
    hot = "Hi, this is Søren, any news? " * 3_000
    rows = [(1, None, "a"), (2, "", "a"), (3, "  ", "a"), (4, "x " * 200_000, "a"), (5, hot, "a"), (6, "😀 Frau Lundsen", "a"), (6, "😀 Frau Lundsen", "a")]
    df = spark.createDataFrame(rows, "id bigint, text string, pii_type string").withColumnRenamed("pii_type", "note")
    found = pii.find_pii(df, ["id"], "text").collect()
    assert sum(r.id == 5 for r in found) == 3_000
    assert [(r.start_pos, r.end_pos) for r in found if r.id == 6] == [(7, 14)] * 2
    assert {r.id for r in found} == {5, 6}
    clear = {r.id: (r.redacted_text, r.replaced) for r in pii.redact_pii(df, ["id"], "text").collect()}
    assert clear[1] == (None, 0) and clear[2] == ("", 0) and clear[6] == ("😀 Frau [NAME]", 1)
    assert clear[5][0] == hot.replace("Søren", "[NAME]")
    assert pii.find_pii(df.limit(0), ["id"], "text").count() == 0


def test_messages_are_exact_on_a_chain_and_pass_over_skips():
    import itertools
    import math

    f = Field(move=[[0.2, 0.1, -2.0], [-0.3, -0.5, 1.5], [0.3, 0.0, 0.4]], agree=[[0.4, 0.9], [0.0, 0.0]])
    unary = [[0.0, 0.3, -1e9], [0.0, -0.2, 0.5], [0.0, 0.1, 0.2]]
    g = Graph([0, 1, 2], unary, [-1, 0, 1], [])
    weight = {}
    for y in itertools.product(range(3), repeat=3):
        weight[y] = math.exp(sum(u[s] for u, s in zip(unary, y, strict=True)) + f.move[y[0]][y[1]] + f.move[y[1]][y[2]])
    z = sum(weight.values())
    for k, m in enumerate(f.marginals(g)):
        for s in range(3):
            assert abs(m[s] - sum(w for y, w in weight.items() if y[k] == s) / z) < 1e-6
    lone = f.marginals(Graph([0, 5], [[0.0, 3.0, -1e9], [0.0, -0.1, -1e9]], [-1, -1], []))[1]
    tied = f.marginals(Graph([0, 5], [[0.0, 3.0, -1e9], [0.0, -0.1, -1e9]], [-1, -1], [(0, 1, 0)]))[1]
    assert tied[1] > lone[1] + 0.05


GIVEN = ["Emily", "Thomas", "Priya", "Giulia", "Ahmed", "Aoife", "Mehmet", "Petra", "Yuki", "Olu"]
FAMILY = ["Johnson", "Becker", "Sharma", "Rossi", "Hassan", "Murphy", "Kaya", "Schneider", "Tanaka", "Adeyemi"]
CLEAR = ["Mein Name ist {} {}, Anschrift folgt.", "Contact: {} {}, desk two.", "I spoke with {} {} at the counter.", "Me llamo {} {} y vivo lejos."]
BARE = ["Danach zweifelte {} lange.", "Then {} shrugged anyway.", "Nothing pleased {} afterwards.", "Later {} insisted twice."]


def _planted(field):
    clear = bare = there = 0
    for given, family in zip(GIVEN, FAMILY, strict=True):
        for first in CLEAR:
            for second in BARE:
                there += 1
                found = {t for _, _, _, t in field.spans(f"{first.format(given, family)} {second.format(family)}")}
                clear += f"{given} {family}" in found
                bare += family in found
    return clear / there, bare / there


def test_names_never_seen_are_found_and_skip_links_carry_them():
    import copy

    clear, bare = _planted(FIELD)
    alone = copy.copy(FIELD)
    alone.agree = [[0.0, 0.0], [0.0, 0.0]]
    clear_alone, bare_alone = _planted(alone)
    assert clear >= 0.9 and clear_alone >= 0.9
    assert bare >= bare_alone + 0.3  # one clear mention makes the bare one known, over the skip link only
    assert not set(map(str.lower, GIVEN + FAMILY)) & FIELD.vocabulary


def test_reducing_the_graph_changes_no_state():
    """What is fixed before messages are passed is what messages over the whole graph say."""
    from tidewater.llm.pii_field import _CASES, _PAD, NEVER, O, candidates, links
    from tidewater.llm.pii_lexer import lex

    for text in [c for c, _ in CASES] + ["Contact: Priya Sharma, desk two. Then Sharma shrugged. The Sharma file went to Priya."]:
        tokens = lex(text)
        seen = [FIELD.view(t) for t in tokens]
        nodes = candidates(tokens, seen)
        chain, skips = links(tokens, nodes)
        padded = [_PAD, _PAD, *seen, _PAD, _PAD]
        unary = []
        follows = set(chain)
        for k, i in enumerate(nodes):
            b, n = FIELD.score(tokens[i].kind, *padded[i : i + 5])
            u = [0.0, b, n if chain[k] >= 0 else NEVER]
            if chain[k] < 0:
                u = [x + FIELD.move[O][s] for s, x in enumerate(u)]
            if k not in follows:
                u = [x + FIELD.move[s][O] for s, x in enumerate(u)]
            unary.append(u)
        full = FIELD.marginals(Graph(nodes, unary, chain, [(a, b, int(seen[nodes[b]][0] not in _CASES)) for a, b in skips]))
        whole = {tokens[i].start for i, m in zip(nodes, full, strict=True) if max(m) != m[O]}
        covered = {t.start for t in tokens for s, e, _, _ in FIELD.spans(text) if s <= t.start < e and t.start in {tokens[i].start for i in nodes}}
        assert whole == covered, text
