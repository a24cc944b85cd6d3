import random
import struct

import pytest
import zstandard

from lectern.llm import warc

SCHEMA = "page_id bigint, url string, html string, file string"


def make(spark, rows):
    return spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA)


def pages(n):
    rng = random.Random(10)
    return [(i, f"https://h{i % 7}.example/p?x={i}", "<html><body class='page'>" + " ".join(rng.choice(["alpha", "beta", "gamma", "<p>delta</p>"]) for _ in range(rng.randrange(20, 200))) + "</body></html>") for i in range(n)]


ODD = [(None, "u", "x"), (900, None, "no url"), (901, "a\r\nb%0D", "odd"), (902, "u", None), (903, "u", ""), (904, "u", "é\r\n\r\n漢" * 50), (904, "u", "é\r\n\r\n漢" * 50), (905, "", "y" * 300_000)]


def test_exact_round_trip(spark):
    rows = pages(300) + ODD
    index = warc.write(make(spark, rows))
    back = warc.read(index).collect()
    assert sorted(map(tuple, back), key=str) == sorted(rows, key=str)
    assert index.count() == len(rows)


def test_records_stand_alone_behind_a_dictionary_frame(spark):
    rows = pages(200)
    index = warc.write(make(spark, rows).coalesce(1)).collect()
    by_id = {r[0]: r for r in rows}
    for r in random.Random(1).sample(index, 20):
        assert warc.read_record(r["file"], r["offset"], r["length"]) == by_id[r["page_id"]]
    with open(index[0]["file"].removeprefix("file://"), "rb") as f:
        data = f.read()
    magic, size = struct.unpack_from("<II", data)
    assert magic == warc.SKIPPABLE and size > 0 and min(r["offset"] for r in index) == 8 + size
    first = min(index, key=lambda r: r["offset"])
    with pytest.raises(zstandard.ZstdError):  # a frame needs the dictionary
        zstandard.ZstdDecompressor().decompress(data[first["offset"] : first["offset"] + first["length"]])
    plain = sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(warc.record(*by_id[r["page_id"]]))) for r in index)
    assert sum(r["length"] for r in index) < plain


@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_files_of_few_or_large_records_have_a_dictionary(n):
    rng = random.Random(n)
    for rows in (pages(n), [(i, "u", rng.randbytes(150_000).hex()) for i in range(n)], [(None, None, None)] * n, [(i, "u", "x" * 9000) for i in range(n)]):
        data, places = warc.encode_file([warc.record(*r) for r in rows])
        size = struct.unpack_from("<I", data, 4)[0]
        assert size >= 64 and places[0][0] == 8 + size
        assert list(warc.decode_file(data)) == rows


def test_empty_table(spark):
    assert warc.round_trip(make(spark, [])).count() == 0
