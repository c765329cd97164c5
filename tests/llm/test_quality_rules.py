import random
import re

from hypothesis import HealthCheck, given, settings, strategies as st

from casewatch.llm import oracle, quality_rules as qr

from .helpers import awkward_documents, documents, tuples

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for spots in places.values() if len(spots) > 1 for i in spots for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def judged(spark, texts):
    frame = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)], ("m", "row", "n_words", "kept"))
    rows = qr.judge(frame)
    names = (*BASE, "base_failed", "kept", "failed_rules")
    return {r[0]: r[1:] for r in rows.select("row.doc_id", *(f"verdict.{n}" for n in names)).collect()}


def test_counts_equal_brute_force(spark):
    rng = random.Random(4)
    texts = [r[1] for r in awkward_documents()]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randrange(30))) for _ in range(60)]
    texts += ["a a a a a", "a b c a b c", "x\ny\nx\n\n \nx", "#*$%&|<>", "é\u00a0ü 日本", "one\x0btwo\x0cthree\rfour", "same line\n" * 500]
    found = judged(spark, texts)
    for i, text in enumerate(texts):
        counts = plain(text)
        assert found[i][:5] == counts, text
        n_words, repeats = counts[0], counts[4]
        assert found[i][5] == (n_words < 50 or 100 * repeats > 50 * n_words)
        if found[i][5]:
            assert not found[i][6]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab# \n\t|é", max_size=60), min_size=20, max_size=60))
def test_counts_of_any_text(spark, texts):
    found = judged(spark, texts)
    assert [found[i][:5] for i in range(len(texts))] == [plain(t) for t in texts]


def test_verdicts_name_the_rules(spark):
    good = "the river and the stone of a garden in winter " + " ".join(f"w{i} the" for i in range(60))
    texts = [good, good.replace(" ", "### "), " ".join(f"zz{i}" for i in range(90)), "\n".join(["the line of it"] * 9 + [f"q{i} of" for i in range(2)])]
    found = judged(spark, texts)
    assert found[0][6] and found[0][7] == []
    assert "symbols" in found[1][7]
    assert found[2][7] == ["stop_words"]
    assert "repeated_lines" in found[3][7]


def test_extra_columns_and_empty_table(spark):
    frame = documents(spark, None, ("row", "kept", "n_words"))
    kept = qr.keep_good(frame)
    assert kept.columns == frame.columns
    assert tuples(qr.judge(documents(spark, []))) == []


def test_a_filter_measures_once(spark):
    plan = qr.keep_good(documents(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64(") == 1


def test_one_projection_without_shuffle_or_user_function(spark):
    plan = qr.judge(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_sql_is_valid():
    expected = {"op4_quality_rules", "op5_url_filters", "op8_warc", "op11_prefix_trie", "op13_centroid_clustering"}
    assert set(oracle.oracle_sql()) == expected


def test_languages_without_a_list_are_not_judged_by_stop_words_or_word_length(spark):
    polish = " ".join(f"zdanie{i} mówi o{i} rzeczach{i} których{i}" for i in range(30))
    unspaced = " ".join("文" * 30 + str(i) for i in range(60))
    rows = [(1, polish, "pl", None, 1), (2, polish, "en", None, 1), (3, polish, None, None, 1), (4, unspaced, "zh", None, 1), (5, unspaced, "DE", None, 1)]
    kept = [r.doc_id for r in qr.keep_good(documents(spark, rows)).collect()]
    assert sorted(kept) == [1, 4]
    assert sorted(r.doc_id for r in qr.keep_good(documents(spark, rows).drop("lang")).collect()) == []


def test_a_very_long_clean_text_is_kept(spark):
    text = " ".join(f"the word{i}" for i in range(520_000))
    assert [r.doc_id for r in qr.keep_good(documents(spark, [(1, text, "en", None, 1)])).collect()] == [1]
