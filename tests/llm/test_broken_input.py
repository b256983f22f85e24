"""Broken markup, and draws of nothing."""

import random

from opspulse.llm import html, quality


def page(middle):
    body = "".join(f"<p>Sentence number {i} of the article says something of its own at length.</p>" for i in range(8))
    return f"<html><body><nav><a href=x>Home</a></nav><article>{body}{middle}{body}</article></body></html>"


def test_marked_sections_do_not_stop_the_parser():
    for odd in ("<![supportMisalignedColumns]>", "<![foo", "<![ >", "<![if !mso]>", "<![endif]>", "<![CDATA[ x > y ]]>", "<!", "<!-", "<![", "<!DOCTYPE [", "<?", "</", "</ ", "&#x", "<![CDATA["):
        text = html.main_text(page(odd))
        assert "Sentence number 0" in text and "Home" not in text, odd


def test_broken_markup_never_raises():
    r = random.Random(7)
    parts = ["<![", "<!--", "-->", "<!", "]]>", "<p>", "</p>", "<div class='", "'>", "<article>", "</article>", "&", "&#", ";", "<", ">", "text ", "<script>", "</script", "<?x", "=", "\x00"]
    for _ in range(400):
        html.main_text("".join(r.choice(parts) for _ in range(r.randint(1, 40))))


def test_nothing_is_drawn_for_k_0_or_low_weights(spark):
    rows = [(i, f"word{i} other{i} third{i} " * 5) for i in range(21)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.resample(docs, labels, keep_text=True, k=0).count() == 0
    assert quality.resample(docs, labels, keep_text=False, k=1).count() == 1
    scored = spark.createDataFrame([(1, -50.0, -49.0)], "doc_id long, log_weight double, sample_key double")
    assert quality.cut(scored) is None
