"""Command line: tag users of a table by rules.

    python -m tallymark.plans.cli user_tags OUT '["tag"]' '["data_word=all:0:word"]' --lines PATH --start_date 20240101 --end_date 20240107
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tallymark.operators.tagging import row_tag_map, sub_scores, tag_map, user_tags

MOST = 1000


def json_list(text: str) -> list[str]:
    """A JSON array of at most MOST strings."""
    try:
        made = json.loads(text)
    except ValueError as e:
        raise argparse.ArgumentTypeError(f"no JSON: {text!r}") from e
    if not isinstance(made, list) or len(made) > MOST or not all(isinstance(x, str) for x in made):
        raise argparse.ArgumentTypeError(f"no array of at most {MOST} strings")
    return made


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallymark")
    commands = parser.add_subparsers(dest="command", required=True)
    command = commands.add_parser("user_tags")
    command.add_argument("filename")
    command.add_argument("tags", type=json_list)
    command.add_argument("tag_rules", type=json_list)
    command.add_argument("--lines", required=True, help="Parquet of (userid, data, apps, date)")
    command.add_argument("--start_date", default="")
    command.add_argument("--end_date", default="99999999")
    command.add_argument("--mode", choices=["data", "user"], default="data", help="tag each row, or each user over all rows")
    given = parser.parse_args(arguments)
    if len(given.tags) != len(given.tag_rules):
        parser.error("there must be as many tags as rules")
    spark = SparkSession.builder.getOrCreate()
    lines = spark.read.parquet(given.lines)
    lines = lines.where(lines["date"].between(given.start_date, given.end_date))
    if given.mode == "data":
        found = row_tag_map(lines, given.tag_rules, given.tags)
    else:
        found = tag_map(user_tags(sub_scores(lines, given.tag_rules), given.tag_rules), given.tags).select("userid", "tags")
    found.write.mode("overwrite").parquet(given.filename)


if __name__ == "__main__":
    main()
