import pytest
from card_rows import card

from tallyframe import CARD
from tallyframe.plans.sizing import INITIAL, MB, SCAN, SHUFFLE, settings_for, sized_for, source_bytes

TB = 1024 * 1024 * MB


@pytest.mark.parametrize("size, partitions, scan", [
    (0, 0, 128 * MB),
    (1, 1, 128 * MB),
    (TB, 4096, 128 * MB),
    (10 * TB, 40_960, 512 * MB),
    (100 * TB, 409_600, 512 * MB),
])
def test_sizes_grow_with_the_source(size, partitions, scan):
    assert settings_for(size) == (partitions, scan)


def test_settings_hold_inside_and_are_restored(spark):
    names = (SHUFFLE, INITIAL, SCAN)
    before = [spark.conf.get(n, None) for n in names]
    with sized_for(spark, 1000):
        assert [spark.conf.get(n, None) for n in names] == before
    with pytest.raises(RuntimeError), sized_for(spark, 100 * TB):
        assert spark.conf.get(SHUFFLE) == spark.conf.get(INITIAL) == "409600"
        assert spark.conf.get(SCAN) == str(512 * MB)
        raise RuntimeError
    assert [spark.conf.get(n, None) for n in names] == before


def test_the_size_comes_from_all_files(spark, tmp_path):
    text = ",".join(CARD.columns) + "\n" + ",".join(card()) + "\n"
    (tmp_path / "sub").mkdir()
    for name in ("a.csv", "b.csv", "sub/c.csv"):
        (tmp_path / name).write_text(text)
    assert source_bytes(spark, str(tmp_path)) == 3 * len(text)
