import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ferrule.llm import mixing, ocr, packing, residue, tokens

# Packing -----------------------------------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=9), st.integers(1, 30))
def test_best_subset_is_best(lengths, room):
    counts = {x: lengths.count(x) for x in lengths}
    got = packing.best_subset(counts, room)
    best = max(sum(c) for n in range(len(lengths) + 1) for c in itertools.combinations(lengths, n) if sum(c) <= room)
    assert sum(x * n for x, n in got.items()) == best and all(n <= counts[x] for x, n in got.items())


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 20), max_size=60))
def test_pack_places_each_item_once(lengths):
    boxes = packing.pack(np.array(lengths, dtype=int), 20)
    assert sorted(i for b in boxes for i in b) == list(range(len(lengths))) and all(sum(lengths[i] for i in b) <= 20 for b in boxes)


def test_containers(spark):
    sizes = spark.createDataFrame([(i, n) for i, n in enumerate([0, 5, 10, 23, 7, 3, 3, 9, 1])], "doc_id bigint, n_tokens bigint")
    packs = spark.createDataFrame([(1, 10), (2, 100), (1, 10)], "pack_id bigint, capacity_tokens bigint")
    out = packing.fill_containers(sizes, packs).toPandas()
    for p, cap in ((1, 10), (2, 100)):
        mine = out[out["pack_id"] == p]
        assert mine.groupby("doc_id")["n_tokens"].sum().to_dict() == {i: n for i, n in enumerate([0, 5, 10, 23, 7, 3, 3, 9, 1])}
        assert (mine.groupby("container_id")["n_tokens"].sum() <= cap).all()
        assert set(mine[mine["piece"] > 0]["doc_id"]) == ({3} if cap == 10 else set())
    assert packing.fill_containers(sizes.limit(0), packs).count() == 0
    rates = packing.fill_rates(packing.fill_containers(sizes, packs), packs.distinct()).toPandas().set_index("pack_id")
    assert rates.loc[1, "n_containers"] == 7 and rates.loc[2, "n_containers"] == 1


def test_tokens(spark):
    df = spark.createDataFrame([(1, "Heating to 5 °C"), (1, "Heating to 5 °C"), (2, None), (3, ""), (4, "<|endoftext|>")], "doc_id bigint, text string")
    n = {r.doc_id: r.n_tokens for r in tokens.sized(df).collect()}
    assert n[2] == n[3] == 0 and n[1] > 3 and n[4] > 1 and len(n) == 4


# Mixing ------------------------------------------------------------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=5), st.integers(0, 60), st.data())
def test_apportionment_by_highest_quotients(weights, seats, data):
    caps = [data.draw(st.integers(0, 30)) for _ in weights]
    got = mixing.sainte_lague([float(w) for w in weights], seats, caps)
    want = [0] * len(weights)
    for _ in range(min(seats, sum(caps))):
        i = max((i for i in range(len(weights)) if want[i] < caps[i]), key=lambda i: (weights[i] / (2 * want[i] + 1), -i))
        want[i] += 1
    assert sum(got) == sum(want) and all(abs(a - b) <= 1 for a, b in zip(got, want))


def test_mix_reaches_shares_within_repeats(spark):
    docs = [(i, ("a", "b", "c", None)[min(i % 7, 3)], 50 + i % 13) for i in range(4000)]
    sizes = spark.createDataFrame(docs, "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("a", 0.5, 3), ("b", 0.3, 1), ("c", 0.2, 2), ("d", 0.0, 1)], "source string, target_share double, max_repeats int")
    for shard in (20_000_000, 8_000):
        drawn = mixing.mix(sizes, targets, block=256, shard_tokens=shard)
        got = {r.source: r for r in mixing.shares(drawn, targets).collect()}
        assert all(abs(got[s].reached_share - t) < 0.03 and got[s].most_repeats <= m for s, t, m in (("a", 0.5, 3), ("b", 0.3, 1), ("c", 0.2, 2)))
        assert got["d"].n_tokens == 0 and drawn.count() == drawn.select("doc_id").distinct().count()
    assert mixing.mix(sizes.limit(0), targets).count() == 0
    assert mixing.sainte_lague([], 3) == [] and mixing.sainte_lague([1.0], 0) == [0]


def test_too_long_parameter_tables_are_errors(spark, monkeypatch):
    sizes = spark.createDataFrame([(1, "a", 5)], "doc_id bigint, source string, n_tokens bigint")
    monkeypatch.setattr(packing, "MOST_PACKS", 1)
    monkeypatch.setattr(mixing, "MOST_SOURCES", 1)
    with pytest.raises(ValueError):
        packing.fill_containers(sizes.select("doc_id", "n_tokens"), spark.createDataFrame([(1, 10), (2, 20)], "pack_id bigint, capacity_tokens bigint"))
    with pytest.raises(ValueError):
        mixing.mix(sizes, spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int"))


# Residue -----------------------------------------------------------------------------------------------------------------


def _trusted(text):
    codes = residue.encode([text], residue.Chunks())[0]
    return bool((codes == residue.END_TRUSTED).any())


@pytest.mark.parametrize("text", ["The value of {{ name }} is given.", "Hardness | %(load)s", "See [TODO: unit].", "Heating to NaN °C leads", "Lorem ipsum dolor sit amet.", "Please enable JavaScript to view this.", "404 Not Found", "Access denied.", "请稍后再试。", "bla bla bla bla"])
def test_trusted_signs(text):
    assert _trusted(text) and _trusted("A line before.\n" + text + "\nand one after")


@pytest.mark.parametrize("text", ["on {111} planes along [001]", "x in {0, 0.5, 1}", "${C}_{11}$ was 248 GPa", "an undefined yield point", "None of the bars failed", 'answered with a "page not found" message', "Density: n/a", "A script is required to convert the maps.", "Yield strength .... 5 MPa", "", "the {Si, B} set", None, " \n ", "\x02"])
def test_no_sign(text):
    assert not _trusted(text)


def test_passages_are_cut_at_lines_and_sentences():
    texts = ["One two. Three four! 5 is, e.g. that. and so on\n\nlast", None, "", "第一句。第二句", "a\x02b"]
    codes = residue.encode(texts, residue.Chunks())
    assert [int((c < 0).sum()) for c in codes] == [4, 0, 0, 2, 1]
    alone = [residue.encode([t], residue.Chunks())[0] for t in texts]
    assert all((a == b).all() for a, b in zip(codes, alone))
    ps = residue.Passages(codes)
    assert list(ps.text) == [0, 0, 0, 0, 3, 3, 4] and len(residue.Passages([]).ends) == 0
    # counts of all passages are the counts of each
    one = sum(ps.counts(np.eye(len(ps.ends))[i]) for i in range(len(ps.ends)))
    assert np.allclose(one, ps.counts(np.ones(len(ps.ends))))


def test_detect_learns_what_the_signs_do_not_show(spark, rows):
    good = [(i, f"The alloy was heated to {i} K and then cooled in air. Slip was seen on {{111}} planes. No. {i} was a good sample of the cast. " * 10) for i in range(800)]
    slots = ["alloy_name", "title", "paper_title", "load"]
    bad = [(1000 + i, f"The alloy was heated to {i} K. Please enable JavaScript to view this article.\nReturn to the start page of the archive.") for i in range(20)]
    bad += [(1100 + i, f"The alloy was heated to {{{{{slots[i % 4]}}}}} K and cooled.\nHardness | {{{{{slots[i % 3]}}}}}") for i in range(40)]
    unsigned = [(1200, "Could you turn on JavaScript to view this article?"), (1201, "Hardness | {%alloy_name%}"), (1202, "You have to let it run: JavaScript to view this article.")]
    odd = [(2000, None), (2001, ""), (2002, "  \n "), (2003, "word " * 20_000), good[0]]
    df = spark.createDataFrame(good + bad + unsigned + odd, "doc_id bigint, text string").selectExpr("*", "'clash' as codes", "1 as n")
    scored = residue.detect(df)
    assert scored.count() == df.count()
    found = {r[0] for r in rows(scored.where("n_residue > 0").select("doc_id").distinct())}
    signed = {i for i, t in good + bad + unsigned + odd if _trusted(t)}
    assert found >= {i for i, _ in bad} | {2003} and not found & {i for i, _ in good}
    assert {1200, 1201} <= found - signed, "the classifier adds records without a sign"
    assert residue.detect(df.limit(0)).count() == 0


# Scanned text ------------------------------------------------------------------------------------------------------------

BLOCKS = "item_no bigint, paper_id string, page int, pos int, typer string, text string, block_label string, bbox array<double>, confidence double, is_layout_noise boolean, paper string, kind string"
TEXTS = "text_no bigint, paper_id string, page int, paper_text string"


@pytest.mark.parametrize("a,b", [("voliime", "volume"), ("hehum", "helium"), ("parncles", "particles"), ("producecl", "produced"), ("conc1ude", "conclude"), ("stren9th", "strength"), ("cryogcnic", "cryogenic"), ("aIloy", "alloy")])
def test_strokes(a, b):
    assert ocr.skeleton(a) == ocr.skeleton(b) != ocr.skeleton(b + "s")


def test_numbers_and_formulas():
    assert ocr.number_of("1O4l") == "1041" and ocr.number_of("B2") and ocr.number_of("word") is None and ocr.number_of("3mm") is None
    els = frozenset(["Ni", "Al", "Cr", "Co", "Fe", "B"])
    assert ocr.formula_fault("Ni60A117Cr14", els) and not ocr.formula_fault("Ni60Al17Cr14", els) and ocr.formula_fault("FeC016", els)


@pytest.mark.parametrize("times", [1, 10])
def test_misread_numbers_whatever_the_size(spark, times):
    lines = ["heated to 5O0 K"] * 3 * times + ["heated to 500 K"] * 60 * times + ["near 82 K"] * times + ["the B2 matrix"] * 20 * times + ["of Ni60A117Cr14"] * 3 * times + ["of Ni60Al17Cr14"] * 60 * times
    content = spark.createDataFrame([("ocr_items", i, 1, x) for i, x in enumerate(lines)], "table_name string, row_no bigint, line_no int, line string")
    tokens = ocr.read_tokens(content)
    counts = tokens.where("kind = 'w'").groupBy("word").agg(ocr.F.sum("n").alias("n"))
    assert [r.word for r in ocr.faulty_numbers(content, tokens).collect()] == ["5O0"] * 3 * times
    assert [r.word for r in ocr.faulty_formulas(tokens, counts).collect()] == ["Ni60A117Cr14"] * 3 * times
    assert {r.meant for r in ocr.faulty_numbers(content, tokens).collect()} == {"500"}


def test_noise_of_pages(spark):
    body = ["The powder was heated in the furnace and the particles were small.", "The particles of the powder were measured in the furnace again."]
    blocks, n = [], 0
    for paper in range(12):
        for page in (1, 2, 3):
            for pos, (text, label, flag) in enumerate([("Journal of Tests 4 (2020) 77", "header" if page != 2 else "text", page == 1 or None), ("\n".join(body * 3), "text", None), (f"Page {page} of 3", "footer", None)]):
                n += 1
                blocks.append((n, f"p{paper}", page, pos, "paragraph", text, label, None, 0.9, flag, "clash", "clash"))
    blocks += [(900, "p0", 1, 5, "paragraph", "The partic-\nles were smaII. The heat-\ntreated powder was 1O5 times measvred.", "text", None, None, None, "", ""), (901, None, None, None, None, None, None, None, None, None, None, None), (902, None, None, 1, "x", "", "text", None, None, None, "", "")]
    blocks.append(blocks[0])
    df = spark.createDataFrame(blocks, BLOCKS)
    texts = spark.createDataFrame([(1, "t1", 1, "The particles of the heat-treated powder were\nsmall in the furnace.\n\n- 12 -"), (2, None, None, None)], TEXTS)
    noise, marked, _ = ocr.find_noise(df, texts)
    got = {(r.table_name, r.row_no, r.line_no, r.noise_kind) for r in noise.collect()}
    assert {("ocr_items", b[0], 1, "running") for b in blocks if b[0] < 900 and b[3] != 1} <= got
    assert sorted(g[2:] for g in got if g[1] == 900) == [(1, "hyphen"), (2, "misread"), (3, "misread")]
    assert ("ocr_items", 900, 1, "hyphen") in got and ("ocr_items", 900, 2, "misread") in got and ("ocr_items", 900, 2, "hyphen") not in got and ("ocr_items", 900, 3, "misread") in got
    assert ("paper_texts", 1, 4, "running") in got
    assert not [g for g in got if g[:2] == ("ocr_items", 2)]
    text = " ".join(r.text for r in ocr.paragraphs(noise, marked).where("paper_id = 'p0'").collect())
    assert "The particles were small." in text and "heat-treated" in text and "Journal" not in text
    empty = ocr.find_noise(df.limit(0), texts.limit(0))
    assert empty[0].count() == 0 and ocr.paragraphs(empty[0], empty[1]).count() == 0


def test_paragraphs_go_on_over_pages(spark):
    line = "table_name string, row_no bigint, paper string, page bigint, pos bigint, label string, line_no int, line string, running boolean"
    rows = [
        ("ocr_items", 1, "p", 1, 0, "text", 1, "The alloy was cast.", False),
        ("ocr_items", 2, "p", 1, 1, "text", 1, "Then the parti-", False),
        ("ocr_items", 3, "p", 1, 2, "figure_title", 1, "Fig. 1 A caption", False),
        ("ocr_items", 4, "p", 2, 0, "paragraph_title", 1, "2 Results", False),
        ("ocr_items", 5, "p", 2, 1, "text", 1, "cles, which were", False),
        ("ocr_items", 5, "p", 2, 1, "text", 2, "small and", False),
        ("ocr_items", 6, "p", 3, 0, "text", 1, "round, were weighed.", False),
        ("ocr_items", 7, "p", 3, 1, "text", 1, "A new one begins", False),
        ("ocr_items", 8, "p", 3, 2, "text", 1, "and ends.", False),
    ]
    noise = spark.createDataFrame([("ocr_items", 2, 1, "hyphen", "parti-cles", "particles", 5, 1)], "table_name string, row_no bigint, line_no int, noise_kind string, word string, meant string, row2 bigint, line2 int")
    out = ocr.paragraphs(noise, spark.createDataFrame(rows, line)).collect()
    assert sorted((r.page, r.text) for r in out) == [
        (1, "Fig. 1 A caption"), (1, "The alloy was cast."), (1, "Then the particles, which were small and round, were weighed."), (2, "2 Results"), (3, "A new one begins and ends."),
    ]
    assert not any(r.goes_on for r in out)
