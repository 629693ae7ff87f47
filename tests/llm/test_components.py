"""Connected components run to their fixed point."""

from pitchstar.llm.common import components


def test_a_path_and_a_star(spark):
    links = [(i + 1, i) for i in range(10, 60)] + [(200, 100 + i) for i in range(5)] + [(7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 10 for i in range(10, 61)}, **{i: 100 for i in (100, 101, 102, 103, 104, 200)}}
