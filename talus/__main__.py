"""python -m talus SOURCE STAGE --input FOLDER --work FOLDER --schema FILE: runs a source's stages on the session's cluster."""

import argparse

from talus.plans import pipeline
from talus.plans.specs import SPECS


def main(argv: list[str] | None = None) -> None:
    ask = argparse.ArgumentParser(description=__doc__)
    ask.add_argument("source", choices=[*SPECS, "survey"])
    ask.add_argument("stage", nargs="?", default="all", choices=[*pipeline.STAGES, "all"])
    for name in ("input", "work", "schema"):
        ask.add_argument(f"--{name}", required=True)
    for name in ("metadata", "mapping", "endpoint", "model", "authorization", "provider", "chart"):
        ask.add_argument(f"--{name}")
    for name in ("top-k", "max-users", "rows-per-file", "shards", "limit"):
        ask.add_argument(f"--{name}", type=int)
    ask.add_argument("--calls-per-second", type=float, default=0.0)
    ask.add_argument("--gate-port", type=int, default=0)
    ask.add_argument("--log-prompts", action="store_true")
    given = ask.parse_args(argv)

    from pyspark.sql import SparkSession

    from talus.operators.extract import ClientConfig, HttpClient, stub

    spark = SparkSession.builder.appName("talus").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if given.source == "survey":
        print(pipeline.survey(spark, given.input, given.schema, given.work, given.limit or 0))
        return
    changes = {k: v for k, v in (("top_k", given.top_k), ("max_users", given.max_users), ("shards", given.shards)) if v is not None}
    config = ClientConfig(given.endpoint, given.model or "", given.authorization or "", given.provider or "local") if given.endpoint else None
    plan = pipeline.Run(
        SPECS[given.source].but(**changes), given.input, given.work, given.schema, given.metadata, given.mapping, given.rows_per_file or 0,
        (lambda: HttpClient(config)) if config else (lambda: stub), log_prompts=given.log_prompts, chart=given.chart,
        calls_per_second=given.calls_per_second, gate_port=given.gate_port
    )
    for path in pipeline.run(spark, plan, given.stage):
        print(path)


if __name__ == "__main__":
    main()
