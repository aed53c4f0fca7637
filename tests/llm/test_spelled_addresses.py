"""Every spelling of an address that the training makes is read, listed and masked."""

import random

import pyarrow as pa
import pytest

from gaugeline.llm import personal_data

ATS = [" at ", " (at) ", "[at]", " [at] ", "(at)"]
DOTS = [".", " dot ", " (dot) ", "[dot]"]
NAMES = ["jane", "omar", "kim", "lena", "ravi", "tomas", "ines", "paul"]
HOSTS = ["example", "mailbox", "kontor", "verein", "studio", "archive"]
FILL = "the of a in and to with for on was write ask today our later team".split()


def _docs(spark):
    draw, rows = random.Random(3), []
    for i in range(400):
        name = f"{draw.choice(NAMES)}.{draw.choice(NAMES)}{draw.choice(['', str(draw.randrange(99))])}"
        address = f"{name}@{draw.choice(HOSTS)}.{draw.choice(['org', 'com', 'net', 'de'])}"
        words = draw.choices(FILL, k=14)
        rows.append((i, " ".join([*words[:7], address, *words[7:]]) + f" at home. Then 12 of {i}"))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_windows_hold_every_spelling():
    settings = personal_data.Settings()
    for at in ATS:
        for dot in DOTS:
            for case in (str, str.upper):
                address = f"roe{case(at)}example{case(dot)}org"
                text = "word " * 40 + address + " word" * 40
                start = text.index(address)
                read = {p for s in personal_data.windows_of(text, settings) for p in range(s, s + settings.window)}
                assert read >= set(range(start, start + len(address))), address
                assert personal_data.fits(text, 0, start, start + len(address)), address
    name = "a" * 70 + " at " + "b" * 70 + ".org"
    read = {p for s in personal_data.windows_of(name, settings) for p in range(s, s + settings.window)}
    assert read >= set(range(len(name)))
    assert personal_data.windows_of("we met at home. Then at noon we left", settings) == []


@pytest.fixture(scope="module")
def docs(spark):
    return _docs(spark).cache()


def test_every_spelling_is_listed_and_masked(spark, docs):
    model = personal_data.fit(docs)
    texts, wants = [], []
    for at in ATS:
        for dot in DOTS:
            for case in (str, str.upper):
                address = f"jane{case(dot)}roe{case(at)}example{case(dot)}org" if dot != "." else f"jane.roe{case(at)}example.org"
                texts.append(f"ask our team today write to {address} for the later")
                wants.append(address)
    found = personal_data.spans_of(pa.array(texts), model, personal_data.Settings())
    missed = []
    for text, want, (base, more) in zip(texts, wants, found):
        masked = personal_data.masked_text(text, base + more)
        if "example" in masked or "[EMAIL]" not in masked:
            missed.append((want, masked))
    assert not missed, missed
