from collections import Counter

import pytest
from pyspark.sql import Row

from sarraf.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept boolean"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 7, None) for i, t, s in rows], SCHEMA)


def plain_repeats(words, width=8):
    windows = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
    times = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(width)})


@pytest.mark.parametrize("text", [
    "", "a", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "x " * 40, "a b " * 9 + "c", " ".join(map(str, range(300))) * 3,
])
def test_repeated_words(text):
    words = text.encode().split()
    assert quality.repeated_words(words) == plain_repeats(words)


def test_stats_count_code_points_and_odd_spaces():
    assert quality.text_stats("é\x0bb c # <>\nx\nx\n \n \n") == (6, 9, 3, 1, 0)
    assert quality.text_stats(None) == quality.text_stats("") == (0, 0, 0, 0, 0)


def words(i, n=30):
    return " ".join(f"w{i}x{k}" for k in range(n))


def test_template_lines_go_and_depleted_documents_are_rejected(spark):
    line = "Subscribe to OUR   list 2024"
    rows = [(i, f"{words(i)}\n{line if i % 2 else line.lower().replace('2024', '1999')}\n", "a") for i in range(40)]
    long_line = " ".join(f"t{k}" for k in range(80))
    rows += [(100 + i, f"{words(100 + i, 25)}\n{long_line}", "b") for i in range(30)]
    rows += [(200 + i, f"{words(7, 25)}\n{long_line}", "c") for i in range(30)]  # copies are no template
    rows += [(300, None, None), (301, "", "a"), (302, "few words", "a"), (303, words(303), None)]
    got = {r.doc_id: r for r in quality.assess(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert all(got[i].lost_words == 5 and got[i].kept for i in range(40))
    assert all(got[i].lost_words == 80 and not got[i].kept and not got[i].base_failed for i in range(100, 130))
    assert all(got[i].lost_words == 0 and got[i].kept for i in range(200, 230))
    assert [got[i].kept for i in (300, 301, 302, 303)] == [False, False, False, True]
    out = quality.clean(frame(spark, rows))
    assert out.columns == SCHEMA.replace(",", "").split()[::2]
    clean = {r.doc_id: r for r in out.collect()}
    assert set(clean) == {i for i in got if got[i].kept}
    assert clean[1].text == f"{words(1)}\n" and clean[1].n_chars == len(clean[1].text)


def test_lines_of_other_content_are_not_one_line(spark):
    assert quality.normalised(b"Page 12 of 340") == quality.normalised(b"page 7  OF 9")
    assert quality.normalised(b"w10x0 w10x1") != quality.normalised(b"w11x0 w11x1")
    assert quality.normalised(b"12 340") != quality.normalised(b"7 9")
    rows = [(i, f"{words(i, 40)}\nstanding line of all\n", "big") for i in range(60)]
    few = [(100 + i, f"{words(100 + i, 40)}\nline of some\n", "big") for i in range(30)]
    rest = [(1000 + i, words(1000 + i, 40), "big") for i in range(610)]
    got = {r.doc_id: r.lost_words for r in quality.assess(frame(spark, rows + few + rest), line_ceiling=25).collect()}
    assert all(got[i] == 4 for i in range(60)) and all(got[100 + i] == 3 for i in range(30))
    got = {r.doc_id: r.lost_words for r in quality.assess(frame(spark, rows + few + rest)).collect()}
    assert all(got[i] == 4 for i in range(60)) and all(got[100 + i] == 0 for i in range(30))


def test_repeated_rows_and_empty_tables(spark):
    docs = frame(spark, [(1, words(1), "a")] * 3 + [(None, words(2), None)] * 2)
    assert quality.clean(docs).count() == 5
    assert quality.assess(docs.limit(0)).count() == 0
    assert quality.clean(docs.limit(0)).collect() == []


def test_very_long_text(spark):
    text = " ".join(f"w{k % 997}" for k in range(200_000))
    row = quality.assess(frame(spark, [(1, text, "a")])).first()
    assert isinstance(row, Row) and row.n_words == 200_000 and row.base_failed and not row.kept
