"""Line labels on texts whose lines are not sentences of a Latin script, and weights that follow the labels."""

import textwrap

import pytest

from tests.llm.conftest import SF
from turnstile.llm import line_crf, queries

PROSE = (
    "The old mill stood at the end of the valley, where the river turned twice before it reached the plain. Nobody had "
    "worked there for years, but the wheel still moved in spring, when the snow of the hills came down all at once."
)
CODE = """import os

def walk(root):
    for name in sorted(os.listdir(root)):
        path = os.path.join(root, name)
        if os.path.isdir(path):
            yield from walk(path)
        else:
            yield path

# prints every file below a folder
"""
C = """#include <stdio.h>

int main(int argc, char *argv[])
{
    int total = 0;
    for (int i = 1; i < argc; i++)
        total += strlen(argv[i]);
    printf("the total is %d", total);
    return 0;
}
"""
VERSE = """Tyger Tyger, burning bright,
In the forests of the night;
On what wings dare he aspire
What the hand, dare seize the fire
"""
HINDI = """एक समय की बात है, किसी गाँव में एक किसान रहता था।
उसके पास दो बैल और थोड़ी सी ज़मीन थी।
और शाम को थककर घर लौट आता था
"""
CHINESE = "\n".join("从前有一个农夫住在山下的村子里他每天清早到田里去干活晚上才回家"[i:] + "。" for i in range(24))
CONTENT = {
    "wrapped": textwrap.fill(PROSE, 40), "one line": PROSE, "code": CODE, "c": C, "verse": VERSE, "hindi": HINDI, "chinese": CHINESE,
}


@pytest.mark.parametrize("name", CONTENT)
def test_content_of_any_form_stays(name):
    assert line_crf.judge(CONTENT[name])[-1]


@pytest.mark.parametrize("width", [20, 78, 10_000])
@pytest.mark.parametrize("mark", ["{}###", "{} |", "{}!!"])
def test_boilerplate_of_any_width_goes(mark, width):
    text = " ".join(mark.format(word.upper() if "!" in mark else word) for word in PROSE.split())
    assert not line_crf.judge("\n".join(textwrap.wrap(text, width)))[-1]


def test_wrapped_documents_keep_their_verdict(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1"), "doc_id")
    texts = [r.text for r in rows.collect() if not line_crf.judge(r.text)[-2]]
    assert texts and all(line_crf.judge(line_crf.rewrapped(t, 78))[-1] for t in texts)


def labelled(spark, junk, rows=60):
    """``rows`` documents with bars or all in capitals; ``junk`` says which of the two is labelled 0."""
    plain = PROSE.split()
    forms = {"bars": " | ".join(plain), "capitals": PROSE.upper()}
    docs = [(2 * i + k, f"{text} {plain[i % 20]}") for i in range(rows) for k, text in enumerate(forms.values())]
    labels = [(i, int(list(forms)[i % 2] != junk)) for i, _ in docs]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


@pytest.mark.parametrize("junk", ["bars", "capitals"])
def test_weights_follow_the_labels(spark, junk):
    docs, labels = labelled(spark, junk)
    kept = {r.doc_id % 2 for r in line_crf.content_documents(docs, labels).collect()}
    assert kept == {("capitals", "bars").index(junk)}


def test_too_few_labels_take_the_fixed_weights(spark):
    docs, labels = labelled(spark, "bars", rows=10)
    assert line_crf.fit_labels(docs, labels) == line_crf.WEIGHTS == line_crf.fit_labels(docs, None)


def test_the_query_reads_the_labels(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(line_crf, "fit_labels", lambda docs, labels: seen.append(labels.columns) or line_crf.WEIGHTS)
    queries.queries()["op7_line_crf"](spark, SF)
    assert seen == [["doc_id", "quality", "toxic"]]
