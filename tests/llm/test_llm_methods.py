"""The methods against brute force on small random inputs."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ratemill.llm import bilstm, chat, decontaminate, kdtree, pii, quality, simhash
from ratemill.llm.components import smallest_reachable
from ratemill.llm.queries import vocabulary


def union_find(nodes, pairs):
    group = {n: n for n in nodes}

    def top(n):
        while group[n] != n:
            n = group[n]
        return n

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        group[b] = a
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("kind", ["path", "star", "random"])
def test_components(spark, kind):
    random.seed(4)
    pairs = {
        "path": [(i, i + 1) for i in range(120)],
        "star": [(500, i) for i in range(300)],
        "random": [(random.randint(0, 400), random.randint(0, 400)) for _ in range(250)],
    }[kind]
    want = union_find({n for pair in pairs for n in pair}, pairs)
    got = smallest_reachable(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["a"]: r["b"] for r in got} == {n: t for n, t in want.items() if n != t}


def test_components_without_links(spark):
    assert smallest_reachable(spark.createDataFrame([(3, 3)], "a long, b long")).count() == 0


@pytest.mark.parametrize("max_bits, free", [(0, 9), (1, 9), (2, 10), (3, 12), (3, 64), (5, 14)])
def test_links_connect_what_all_pairs_connect(spark, max_bits, free):
    """Also where all fingerprints share most bytes, so that lists are split."""
    draw = np.random.default_rng(max_bits)
    base = int(draw.integers(0, 1 << 62))
    spots = draw.permutation(64)[:free].tolist()
    prints = set()
    for _ in range(700):
        flips = draw.choice(spots, int(draw.integers(0, min(free, 8))), replace=False).tolist()
        prints.add((base ^ sum(1 << s for s in flips)) if len(prints) % 3 else int(draw.integers(0, 1 << 62)))
    values = np.array(sorted(prints), np.uint64).view(np.int64)
    pairs = [
        (values[i].item(), values[j].item())
        for i in range(len(values))
        for j in np.nonzero(np.bitwise_count((values ^ values[i]).view(np.uint64)) <= max_bits)[0]
    ]
    table = spark.createDataFrame([(v,) for v in values.tolist()], "fp long")
    links = [(r["a"], r["b"]) for r in simhash.links(table, max_bits, list_rows=4).collect()]
    assert union_find(values.tolist(), links) == union_find(values.tolist(), pairs)


def test_position_sets_avoid_any_three():
    masks = [m % (1 << 64) for m in simhash.position_masks(3)]
    assert len(masks) == 14
    for a in range(8):
        for b in range(8):
            for c in range(8):
                hit = (0xFF << 8 * a) | (0xFF << 8 * b) | (0xFF << 8 * c)
                assert any(not mask & hit for mask in masks)


def test_fingerprint_in_plain_python():
    import xxhash

    for text in ["one two", "A b C d e f", "the cat sat the cat sat the cat", "É É\u0085x y z\x0bw"]:
        words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\x0b", " ").split(" ") if w]
        grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        want = sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint_of(text, 3) % (1 << 64) == want


VOCABULARY = vocabulary()


@given(st.text(st.sampled_from("abcdeinorst \n'1é日\U0001f986"), max_size=60))
@settings(max_examples=400, deadline=None)
def test_bpe_matches_the_library(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(VOCABULARY.encode(text), "<u4").tolist() == ids
    assert VOCABULARY.decode(np.array(ids, "<u4").tobytes()) == text


def test_decoding_cut_characters():
    ids = np.frombuffer(VOCABULARY.encode("\U0001f986"), "<u4")
    assert "�" in VOCABULARY.decode(ids[:1].astype("<u4").tobytes())


@given(st.lists(st.lists(st.integers(-3, 3), min_size=3, max_size=3), min_size=1, max_size=60), st.integers(1, 6))
@settings(max_examples=60, deadline=None)
def test_tree_search_is_exact(rows, k):
    points = np.array(rows, np.float64)
    ids = np.arange(len(rows)) // 2
    tree = kdtree.Tree(points, ids, leaf_rows=2)
    for own, query in enumerate(points[:5]):
        found, scores = tree.search(query, tree.bounds(query[None])[0], k, -np.inf, own)
        want = sorted((-float(points[i] @ query), int(ids[i])) for i in range(len(rows)) if i != own)[:k]
        assert [(-s, int(ids[i])) for i, s in zip(found, scores)] == want


def test_tagger_gradients():
    tagger = bilstm.Tagger.new(5, 3, 3)
    tagger.weights = {n: w.astype(np.float64) for n, w in tagger.weights.items()}
    draw = np.random.default_rng(0)
    kinds, gold = draw.integers(0, 5, (7, 4)), draw.integers(0, 3, (7, 4))
    _, gradients = tagger.gradients(kinds, gold)
    for name, weight in tagger.weights.items():
        at = tuple(int(draw.integers(0, n)) for n in weight.shape)
        losses = []
        for change in (1e-2, -1e-2):
            weight[at] += change
            losses.append(tagger.gradients(kinds, gold)[0])
            weight[at] -= change
        assert abs((losses[0] - losses[1]) / 2e-2 - gradients[name][at]) < 1e-3


def test_skipped_steps_have_no_better_path():
    """Whole sequences against a search of every step, between two steps of tag 0."""
    draw = np.random.default_rng(1)
    tagger = bilstm.Tagger.new(6, 4, 4)
    for bias in (0.0, 1.5, 4.0):
        tagger.weights["transitions"] = draw.normal(0, 0.5, (4, 4)).astype(np.float32)
        scores = [draw.normal(0, 2, (n, 4)).astype(np.float32) for n in (*range(40), 700)]
        for s in scores:
            s[:, 0] += bias
        border = np.array([[0, -1e9, -1e9, -1e9]], np.float32)
        for found, s in zip(tagger.decode([s.T for s in scores]), scores):
            whole = tagger._viterbi(np.concatenate([border, s, border])[:, :, None])[1:-1, 0]
            assert (found == whole).all()


def test_scores_of_overlapping_windows_are_joined():
    """A tag that both windows half support at a seam is decided by their average."""

    class Seams:
        """Scores tell how far a character is inside its window."""

        def emissions(self, kinds):
            inside = np.arange(len(kinds), dtype=np.float32)[:, None, None]
            return np.broadcast_to(inside, (len(kinds), len(pii.KINDS) + 1, kinds.shape[1])).copy()

    text = "x" * (2 * pii.CORE + 5)
    scores = pii.joined_scores([text, "y"], Seams(), pii.kinds_table())
    assert [s.shape[1] for s in scores] == [len(text), 1]
    for at in range(len(text)):
        window, place = divmod(at, pii.CORE)
        want = place + pii.MARGIN
        for seam in (pii.CORE, 2 * pii.CORE):
            if abs(at + 0.5 - seam) < pii.MARGIN:
                weight = (at - seam + pii.MARGIN + 0.5) / (2 * pii.MARGIN)
                later = at - seam + pii.MARGIN
                want = weight * later + (1 - weight) * (later + pii.CORE)
        assert np.allclose(scores[0][:, at], want)


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return docs, pii.train(docs)


def test_spans_at_seams(trained):
    """A span in a form the patterns miss is found wherever windows meet in it."""
    tagger, table = trained[1], pii.kinds_table()
    found = 0
    for shift in range(-24, 8):
        lead = ("and so it went on " * 40)[: pii.CORE + shift - 1] + " "
        part = "mail anna.berg(at)example(dot)org now"
        (_, spans), = pii.spans_of([lead + part + " and so it went on" * 5], tagger, table)
        found += (len(lead) + 5, 0, len(lead) + 5 + len("anna.berg(at)example(dot)org")) in spans
    assert found >= 28


def test_added_spans_on_held_out_documents(trained):
    rows = pii.held_out_counts(*trained).where("form = 'added'").collect()
    gold, found, right = (sum(row[n] for row in rows) for n in ("n_gold", "n_found", "n_right"))
    assert {row["kind"] for row in rows} == set(pii.KINDS) and gold >= 50
    assert right / found >= 0.95 and right / gold >= 0.85


def test_forms_that_are_no_personal_data():
    for rank, part in [(0, "at the end"), (0, "a @ b"), (1, "300 . 1 . 1 . 1"), (2, "1234.5678.9012.3456"), (3, "0123456789012"), (3, "00 12 34")]:
        assert not pii._form(rank, part)
    draw = np.random.default_rng(4)
    for rank, part in [(0, "a.b@c-d.org"), (1, "10.0.255.1"), (2, "4111111111111111"), (3, "+49 (30) 1234567")]:
        for _ in range(30):
            assert pii._form(rank, pii.rewritten(rank, part, draw))
            assert not pii.base_spans(pii.rewritten(0, "a.b@c-d.org", draw)) or rank


def test_windows_cover_a_text_once():
    tagger, table = bilstm.Tagger.new(pii.N_CHARACTER_KINDS, 5, 4), pii.kinds_table()
    texts = ["", "x", "a" * pii.CORE, "b1@." * 300]
    tags = pii.tag_texts(texts, tagger, table)
    assert [len(t) for t in tags] == [len(t) for t in texts]
    alone = [pii.tag_texts([t], tagger, table)[0] for t in texts]
    assert all((a == b).all() for a, b in zip(tags, alone))


def test_prior_of_a_known_mixture():
    draw = np.random.default_rng(2)
    good, bad = draw.normal(2, 1, 20_000), draw.normal(-2, 1, 20_000)
    mixed = np.concatenate([good[:7000], bad[:3000]])
    assert abs(quality.class_prior(good[7000:], mixed) - 0.7) < 0.04


def test_pu_learning_without_negatives():
    draw = np.random.default_rng(3)
    good = draw.normal(0.3, 0.1, (10_000, quality.N_FEATURES))
    bad = draw.normal(0.1, 0.1, (3000, quality.N_FEATURES))
    model = quality.fit(good[:4000], np.concatenate([good[4000:8000], bad[:1500]]))
    assert abs(model.prior - 4000 / 5500) < 0.1
    assert (model.score(good[8000:]) >= 0.3).mean() > 0.95
    assert (model.score(bad[1500:]) >= 0.3).mean() < 0.05


def test_words_of_both_cases(spark):
    rows = spark.createDataFrame([("A-bÉC 9z_q",), ("PLAIN Ascii",)], "t string")
    found = [r[0] for r in rows.select(decontaminate.words_of(rows["t"])).collect()]
    assert found == [["a", "bÉc", "9z", "q"], ["plain", "ascii"]]


def test_links_of_a_hub(spark):
    """A star of many leaves, a chain and single links, against union-find."""
    pairs = [(0, n) for n in range(1, 3000)] + [(n, n + 1) for n in range(5000, 5040)] + [(9000, 8000)]
    links = spark.createDataFrame([(b, a) if a % 2 else (a, b) for a, b in pairs], "a long, b long")
    found = {r["a"]: r["b"] for r in smallest_reachable(links).collect()}
    groups = union_find({n for pair in pairs for n in pair}, pairs)
    assert found == {n: low for n, low in groups.items() if n != low}


def test_examples_of_a_long_conversation(spark):
    """Every example is the pieces before it and its own, whatever the order of rows."""
    turns = [(1, n, "assistant" if n % 3 == 2 else "user", f"### t{n} </turn>\\" + "x" * (n % 7)) for n in range(400)]
    rows = spark.createDataFrame(turns[::-1], "conv_id long, turn long, role string, text string")
    found = sorted(chat.format_examples(rows).collect(), key=lambda r: r["turn_number"])

    def escaped(text):
        return text.replace("\\", "\\b").replace("### ", "\\h").replace("</turn>", "\\e")

    pieces = [f"### {role}: {escaped(text)}</turn>\n" for _, _, role, text in turns]
    ends = [n + 1 for n in range(400) if n % 3 == 2 or n == 399]
    assert [r["turn_number"] for r in found] == ends
    for row in found:
        whole = "".join(pieces[: row["turn_number"]])
        assert row["formatted"] == whole
        if turns[row["turn_number"] - 1][2] == "assistant":
            reply = escaped(turns[row["turn_number"] - 1][3])
            assert whole[row["loss_start"] : row["loss_end"]] == reply
            assert row["loss_end"] == len(whole) - len("</turn>\n")
        else:
            assert row["loss_start"] is None and row["loss_end"] is None
