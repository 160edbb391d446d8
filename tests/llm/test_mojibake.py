import difflib
import random
import re

import pytest

from sluice.llm import mojibake as mb

SENTENCES = [
    "Die Prüfung der Überschrift ergab drei ungültige Einträge für März.", "Le coût de l’étape « curated » a été vérifié près de la clé.", "¿Quién cambió el nombre de la columna después del análisis?",
    "A reposição das linhas não está concluída, atenção à posição.", "Proszę sprawdzić, czy kolumna będzie później uzupełniona, różnica została wyjaśniona.", "Загрузка остановлена: проверка показала расхождение между таблицами.",
    "The vendor’s “summary” cost 20 € – see the annex… and café notes.", "Plain words without any accent at all.",
]
RARE = "Plan names such as “SÃO Vital”, “ÂME Extra” or “Ðagur” © ™ stay."


def corpus(seed, n=900):
    rnd = random.Random(seed)
    return [" ".join(rnd.sample(SENTENCES, rnd.randrange(1, 4)) + ([RARE] if rnd.random() < 0.3 else [])) for _ in range(n)]


def garble(text, chain):
    read, written = chain
    raw = text.encode(written, "ignore")
    return "".join(bytes([b]).decode(read, "ignore") or chr(b) for b in raw) if written != "utf-8" else "".join(_one(b, read) for b in raw)


def _one(b, read):
    try:
        return bytes([b]).decode(read)
    except UnicodeDecodeError:
        return chr(b)


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t, "x") for i, t in enumerate(corpus(1))] + [(5000, None, None), (5001, "", ""), (5002, garble(SENTENCES[1], ("cp1252", "utf-8")), "y")]
    return mb.train(spark.createDataFrame(rows, "doc_id bigint, text string, n_lost string").repartition(3))


def test_held_out_clean_text_is_left_alone(model):
    assert all(model.repair(t) == (t, 0, 0) for t in corpus(2, 200))


@pytest.mark.parametrize("chain", [("cp1252", "utf-8"), ("latin-1", "utf-8"), ("cp437", "utf-8"), ("cp850", "utf-8"), ("mac_roman", "utf-8"), ("cp1250", "utf-8")])
@pytest.mark.parametrize("sentence", SENTENCES[:5] + SENTENCES[6:7])
def test_utf8_read_as_another_charset_is_restored(model, chain, sentence):
    bad = garble(sentence, chain)
    got, restored, lost = model.repair("Plain words. " + bad)
    assert restored > 0 and got == "Plain words. " + sentence


@pytest.mark.parametrize("chain", [("cp1252", "utf-8"), ("cp1251", "utf-8"), ("cp866", "utf-8"), ("cp1252", "cp1251"), ("cp1251", "koi8_r"), ("koi8_r", "cp1251")])
def test_cyrillic_is_restored(model, chain):
    got, restored, _ = model.repair(garble(SENTENCES[5], chain))
    right = sum(a == b for a, b in zip(got, SENTENCES[5], strict=False)) / len(SENTENCES[5])
    assert restored > 0 and right > 0.9


def test_twice_garbled(model):
    once = garble(SENTENCES[0], ("cp1252", "utf-8"))
    assert model.repair(garble(once, ("cp1252", "utf-8")))[0] == SENTENCES[0]


def test_every_occurrence_is_evidence(model):
    assert model.repair("Plain words " + "fьr " * 10 + "end") == ("Plain words " + "für " * 10 + "end", 10, 0)


def test_repeats_of_a_likelier_refill_are_no_evidence_for_a_chain():
    filled = mb.Rewriting("–", 19.7, mb.LOSSY, 1)
    letter = mb.Rewriting("в", 18.3, "cp1252>cp1251", 1, agreeing=("cp1252>cp1251",), instead=filled)
    assert mb.evidence([letter] * 5) == {"cp1252>cp1251": 1} and mb.evidence([mb.replace(letter, instead=None)] * 5) == {"cp1252>cp1251": 5}


def test_chains_that_agree_share_their_evidence(model):
    words = "kolumna będzie później"
    assert model.repair("Plain words. " + garble(words, ("cp1252", "iso8859_2")) + " kolumna")[0] == f"Plain words. {words} kolumna"


def test_a_short_passage_is_judged_by_its_gain(model):
    assert model.short_margin >= model.margin
    assert model.repair("Plain words. " + garble("Überprüfung", ("cp1251", "cp1252")))[0] == "Plain words. Überprüfung"


def test_lost_characters_are_found(model):
    assert model.repair("Qui�n cambi� el nombre")[2] == 2
    assert model.repair("Itâs the vendorâs summary, itâs")[1] > 0


def test_dropped_bytes_are_refilled_behind_characters_the_corpus_has_not_before_them(model):
    got, restored, _ = model.repair("Plain words and Quizâs plan.")
    assert restored == 1 and got.isascii() is False and "â" not in got


@pytest.mark.parametrize("cluster", ["Quizâs", "âsummaryâ", "vendorâs", "lâétapeâ\xa0x", "ââ\u3000\u3000â", "Ã©tapeâs", "â"])
def test_local_scores_refill_as_whole_ones_do(model, cluster):
    left, right = " " * (cluster[0] > "~"), " " * (cluster[-1] > "~")
    want = set()
    for start in {cluster, *(mb._rewrite(cluster, mb.utf8_units(cluster, c)) for c in ("latin-1", "cp1252"))}:
        t = start
        for i in range(len(start)):
            options = [t] + [t[:i] + ch + t[i + n :] for n in (1, 2, 3) if i + n <= len(t) for ch in model.residues.get(t[i : i + n], ())]
            t = max(options, key=lambda o: round(model.score(left + o + right), 9))
        want |= {t} - {start}
    assert set(model._refilled(cluster, left, right)) == want


SIZE = mb.CODE_POINTS + (1 << mb.BI_BITS) + (1 << mb.TRI_BITS)


def test_counts_equal_a_loop():
    texts = ["", "a", "ab", " a \t\u3000 b\n12x7 ", "\n\n", "für 10 Städte", "\U0001f600 \x85\x1c!", "  x", "\ud800"]
    counts, want = mb.np.zeros(SIZE, dtype="int64"), mb.np.zeros(SIZE, dtype="int64")
    mb.count_grams(texts, counts)
    mb.count_grams([], counts)
    for t in texts:
        c = [ord(x) for x in mb.normal(t)]
        for i, x in enumerate(c):
            want[x] += 1
            if i:
                want[mb.CODE_POINTS + mb._bi(c[i - 1], x)] += 1
            if i > 1:
                want[mb.CODE_POINTS + (1 << mb.BI_BITS) + mb._tri(c[i - 2], c[i - 1], x)] += 1
    assert (counts == want).all() and counts.sum() > 60


def test_long_text_without_blanks_is_refilled():
    phrases = ["これは検証の結果です。", "表の列を確認してください。", "取り込みは完了しました。", "差分が見つかりました。", "この行は除外されます。"]
    rnd = random.Random(3)
    texts = ["".join(rnd.choices(phrases, k=4)) for _ in range(300)]
    counts = mb.np.zeros(SIZE, dtype="int64")
    mb.count_grams(texts, counts)
    japanese = mb.Model(counts.astype("int32"), mb.residues(set("".join(phrases))))
    text = "".join(phrases * 4)
    bad = re.sub("[\x80-\x9f]", "", text.encode().decode("latin-1"))
    assert len(bad) > 200 and mb.cluster_spans(bad) == [(0, len(bad))]
    got, restored, _ = japanese.repair(bad)
    assert restored == 1 and alike(got, text) > 0.9


def alike(a, b):
    return difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()


def test_every_record_comes_out(spark, model):
    rows = [(1, None, "x"), (2, "", "x"), (3, "ascii only", "x"), (4, garble(SENTENCES[3], ("cp1252", "utf-8")), "x"), (5, SENTENCES[3] * 2000, "x")]
    got = {r.doc_id: (r.text, r.n_restored > 0, r.n_lost) for r in mb.repair_corpus(spark.createDataFrame(rows, "doc_id bigint, text string, extra string"), model).collect()}
    assert got == {1: (None, False, 0), 2: ("", False, 0), 3: ("ascii only", False, 0), 4: (SENTENCES[3], True, 0), 5: (SENTENCES[3] * 2000, False, 0)}


def test_copies_of_a_held_out_record_leave_the_thresholds_alone(spark):
    simple = spark.range(200).selectExpr("concat('Die Prüfung ', id) AS text")
    held = simple.filter(mb.F.pmod(mb.F.xxhash64("text"), mb.F.lit(mb.HELD_OUT_SHARE)) == 0).orderBy("text").first().text
    rows = spark.createDataFrame([(t,) for t in [*corpus(4), held]], "text string").dropDuplicates()
    copies = rows.unionByName(spark.createDataFrame([(held,)] * 3000, "text string"))
    one, many = mb.train(rows), mb.train(copies)
    assert (one.margin, one.short_margin, one.floor) == (many.margin, many.short_margin, many.floor)


def test_a_character_of_two_records_is_known_at_any_size(spark):
    many = spark.range(60_000).selectExpr("CASE WHEN id < 2 THEN concat('snow ☃ ', id) ELSE concat('plain ', id) END AS text")
    assert mb.known_characters(many, "text") == {"☃"}


def test_quantiles_of_histograms():
    rnd = random.Random(2)
    values = [rnd.randrange(-5000, 5000) for _ in range(777)]
    for share in (0.0, 0.005, 0.5, 0.995, 1.0):
        assert mb._quantile({v: values.count(v) for v in values}, share) * mb.STEPS == mb.np.quantile(values, share, method="lower")


def test_empty_corpus(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    m = mb.train(empty)
    assert m.margin == mb.LEAST_MARGIN and mb.repair_corpus(empty, m).count() == 0


def test_found_are_the_restored_and_the_lost(spark, model):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["fÃ¼r das Feld", "für das Feld", "plain", None, "", "lost \ufffd here", "Ã¼ber die MÃ¶glichkeit"])], "doc_id bigint, text string")
    want = sorted((r.doc_id, r.n_restored, r.n_lost) for r in mb.repair_corpus(df, model).collect() if r.n_restored + r.n_lost)
    assert sorted(map(tuple, mb.garbled_records(df, model).collect())) == want and {w[0] for w in want} >= {0, 5}
