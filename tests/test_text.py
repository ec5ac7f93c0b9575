from pyspark.sql import functions as F

from loanweave.functions import text as tx


def apply(spark, function, values):
    frame = spark.createDataFrame([(n, value) for n, value in enumerate(values)], "n int, s string")
    return [row[0] for row in frame.orderBy("n").select(function(F.col("s"))).collect()]


def test_normalize_text(spark):
    assert apply(spark, tx.normalize_text, [None, "", "  a \t b  c ", "\x1cx\x1f y"]) == ["", "", "a b c", "x y"]


def test_parse_subjects(spark):
    values = [None, "", "Rock ; ;Jazz;rock ; Été "]
    assert apply(spark, tx.parse_subjects, values) == [[], [], ["rock", "jazz", "rock", "été"]]


def test_author_label(spark):
    values = [None, "", "   ", "Hugo, Victor, 1802-1885", "Eco,  Umberto, 1932-.", "1999", "Roy A. 1961-", "Li, 20 x"]
    wanted = ["__UNKNOWN__"] * 3 + ["hugo, victor", "eco, umberto", "__UNKNOWN__", "roy a.", "li, 20 x"]
    assert apply(spark, tx.author_label, values) == wanted


def test_publisher_and_title(spark):
    assert apply(spark, tx.clean_publisher, [None, "", "  ", " Le  Seuil "]) == ["__UNKNOWN__", "__UNKNOWN__", "", "Le Seuil"]
    assert apply(spark, tx.clean_title, [None, " A  tale / ", "a / b", "x /y/"]) == ["", "A tale", "a / b", "x /y"]


def test_author_names(spark):
    values = [
        None,
        "Hugo, Victor, 1802-1885",
        "Uderzo, Albert & Goscinny, René, 1926-1977; Uderzo, Albert",
        "; &",
        "Plato",
    ]
    wanted = [None, "Victor Hugo", "Albert Uderzo; René Goscinny", "", "Plato"]
    assert apply(spark, tx.author_names, values) == wanted


def test_normalize_subject(spark):
    values = [None, "", "Éducation--Histoire, 1914-1918", "ﬁn de siècle / Suisse", "C++ (langage) 2020", "Straße", "a1999b"]
    wanted = ["", "", "education histoire", "fin de siecle suisse", "c langage", "straße", "a1999b"]
    assert apply(spark, tx.normalize_subject, values) == wanted


def test_isbn_list(spark):
    values = [None, "", "2-07-036822-x; 978-2-07-036822-8 ;9782070368228;12", "XXXXXXXXXX", "978207036822X"]
    wanted = [[], [], ["9782070368228", "207036822X"], ["XXXXXXXXXX"], []]
    assert apply(spark, tx.isbn_list, values) == wanted


def test_cover_candidates(spark):
    frame = spark.createDataFrame([("2070368228", None), ("2070368228", "c"), (None, None), (None, "c")], "s string, c string")
    rows = frame.select(tx.cover_candidates(F.col("s"), "M", F.col("c"))).collect()
    url = "https://covers.openlibrary.org/b/isbn/2070368228-M.jpg"
    assert [row[0] for row in rows] == [[url, tx.NO_COVER], ["c", url, tx.NO_COVER], [tx.NO_COVER], ["c", tx.NO_COVER]]


def test_display(spark):
    assert apply(spark, tx.escape_html, ["<a href='x'>&\"</a>"]) == ["&lt;a href=&#x27;x&#x27;&gt;&amp;&quot;&lt;/a&gt;"]
    assert apply(spark, lambda c: tx.shorten(c, 3), ["abcd", "abc"]) == ["abc...", "abc"]
    values = [None, "<b>One</b>; two & three ;;four", "  "]
    assert apply(spark, tx.subject_badges, values) == [[], ["One", "two &amp; three", ""], []]


def test_char_ngrams(spark):
    found = apply(spark, tx.char_ngrams, ["a", "ab cde", ""])
    assert found[0] == [" a "]
    assert sorted(found[1]) == sorted([" ab", "ab ", " ab ", " cd", "cde", "de ", " cde", "cde ", " cde "])
    assert found[2] == []
