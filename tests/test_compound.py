"""Containers of older office files, whole and damaged."""

import random
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.sources import compound, files


def streams_of(seed):
    rng = random.Random(seed)
    sizes = [0, 1, 63, 64, 65, 511, 512, 4095, 4096, 4097, 9000, 70_000]
    return {f"{'store/' * (k % 3)}s{k}": rng.randbytes(n) for k, n in enumerate(rng.sample(sizes, len(sizes)))}


@pytest.mark.parametrize("seed", range(4))
def test_streams_come_back(seed):
    want = streams_of(seed)
    held = compound.Compound(compound.build(want))
    assert sorted(held.names()) == sorted(want) and all(held.stream(n) == want[n] for n in want)


def test_tables_beyond_the_header():
    """Over 109 tables of sectors: 8 MB."""
    want = {"big": random.Random(1).randbytes(8_000_000), "small": b"x"}
    data = compound.build(want)
    assert struct.unpack_from("<I", data, 72)[0] > 0
    held = compound.Compound(data)
    assert all(held.stream(n) == want[n] for n in want)


def test_a_circle_in_the_tree():
    data = bytearray(compound.build({"a": b"1", "b": b"2"}))
    directory = (struct.unpack_from("<I", data, 48)[0] + 1) * 512
    struct.pack_into("<I", data, directory + 128 * 2 + 72, 1)  # b's right neighbour is a
    with pytest.raises(compound.Damaged, match="circle in the tree"):
        compound.Compound(bytes(data))


def test_a_circle_of_sectors_ends():
    data = bytearray(compound.build({"a": b"1" * 5000, "b": b"2" * 5000}))
    table = (struct.unpack_from("<I", data, 76)[0] + 1) * 512
    struct.pack_into("<I", data, table, 0)  # a's first sector follows itself
    held = compound.Compound(bytes(data))
    assert held.stream("b") == b"2" * 5000
    with pytest.raises(compound.Damaged, match="chain without an end"):
        held.stream("a")


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**9), st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 255)), max_size=20), st.integers(0, 10**6))
def test_damage_never_hangs(seed, changes, cut):
    data = bytearray(compound.build({"FileHeader": bytes(256), "BodyText/Section0": compound.hwp_section("some text " * 600, False), "x": b"y" * 100}))
    for at, value in changes:
        data[at % len(data)] = value
    data = bytes(data[: len(data) - cut % 2000])
    try:
        held = compound.Compound(data)
        for name in held.names():
            held.stream(name)
    except (compound.Damaged, struct.error):
        pass


TEXT = "첫째 줄\ttab\n둘째 줄 " + "long " * 1500


@pytest.mark.parametrize("packed", [True, False])
def test_word_processor_files(packed):
    header = bytes(36) + bytes([packed]) + bytes(100)
    parts = {f"BodyText/Section{k}": compound.hwp_section(t, packed) for k, t in enumerate(["short one", TEXT, " \n ", "the last"])}
    assert files.hwp(compound.build({"FileHeader": header, **parts})) == f"short one\n{TEXT}\nthe last"
    if packed:
        broken = compound.build({"FileHeader": header, **parts, "BodyText/Section1": b"\xff\xff\xff no deflate"})
        assert files.hwp(broken) == "short one\nthe last"


def test_older_office_files(spark):
    words = "readable words in a row".encode("utf-16-le")
    cases = {
        ".doc": compound.build({"WordDocument": b"\1\0" + words, "1Table": "table text here".encode("utf-16-le")}),
        ".ppt": compound.build({"PowerPoint Document": words, "Current User": "too short".encode("utf-16-le")}),
        ".xls": compound.build({"Workbook": words, "deep/er": "eleven chars".encode("utf-16-le")}),
        ".hwp": b"no container",
    }
    rows = spark.createDataFrame([(e, bytearray(d)) for e, d in cases.items()], "ext string, content binary")
    got = {r.ext: (r.text, r.error) for r in files.converted(rows).collect()}
    assert got[".doc"] == ("readable words in a row", None) and got[".ppt"][0] == "readable words in a row"
    assert set(got[".xls"][0].split("\n")) == {"readable words in a row", "eleven chars"}
    assert got[".hwp"] == (None, "conversion: Damaged: no compound file")
    only_table = compound.build({"WordDocument": b"\1\2", "1Table": "table text here".encode("utf-16-le")})
    assert files.doc(only_table) == "table text here" and files.doc(compound.build({"x": b"y"})) == ""
