"""Small API surface: filters, JDBC argument checks, command-line arguments."""

import pytest

from donorlens.__main__ import main, parse_args
from donorlens.operators import basic
from donorlens.sources.jdbc import read_jdbc_table
from tests.helpers import contribution as c, make_tables


def test_row_filters(spark):
    t = make_tables(spark, [c("U1", 2000, gender="F"), c("U2", 2002, gender="M"), c("U3", 2000, gender="M")])
    assert basic.cycle_filter(t.contributions, 2000).count() == 2
    assert basic.gender_filter(t.contributions, "M").count() == 2
    assert [r["cycle"] for r in basic.distinct_values(t.contributions, "cycle", sort=True).collect()] == [2000, 2002]
    parties = spark.createDataFrame([("a'b",), ("D",)], "party string")
    # a quote in a party value is just data
    assert basic.party_filter(parties, "a'b").count() == 1


def test_jdbc_partitioned_read_needs_bounds(spark):
    with pytest.raises(ValueError, match="lower_bound"):
        read_jdbc_table(spark, "jdbc:none://nowhere", "individual_contributions", {}, partition_column="cycle")


def test_command_line_arguments():
    args = parse_args(["--csv-dir", "/x", "--out", "/y", "--mode", "as_coded", "--sample", "100"])
    assert (args.csv_dir, args.out, args.mode, args.sample) == ("/x", "/y", "as_coded", 100)
    with pytest.raises(SystemExit):
        parse_args(["--out", "/y"])                    # a source is required
    with pytest.raises(SystemExit):
        main(["--csv-dir", "/x"], spark=object())      # an output is required
