"""python -m cadenza doctor [PROJECT.json] | projects FOLDER | plan STAGE PROJECT.json | apply STAGE PROJECT.json | all PROJECT.json"""

from __future__ import annotations

import sys
from pathlib import Path

from cadenza.config import list_projects, parse_project
from cadenza.plans import pipeline
from cadenza.session import session
from cadenza.sources.scratch import Scratch


def doctor(project: str | None = None) -> int:
    """Versions of what is needed, and a table written to the shared folder and read again; of a project, which stages have their inputs."""
    import duckdb
    import numpy
    import pandas
    import pyarrow
    import pyspark

    for m in (pyspark, pyarrow, pandas, numpy, duckdb):
        print(f"{m.__name__} {m.__version__}")
    spark = session("doctor")
    ok = Scratch(spark, "doctor").write(spark.range(10), "t").count() == 10
    print("parquet", "works" if ok else "fails")
    if project:
        w = _workspace(spark, project)
        for name in pipeline.ALL:
            missing = pipeline.missing(w, name)
            print(name, "ready" if not missing else f"lacks {', '.join(missing)}")
        for table, inputs in w.tables.behind().items():
            print(f"{table} is behind {', '.join(inputs)}")
    ok &= separation_smoke(spark)
    return int(not ok)


def separation_smoke(spark, make=None) -> bool:
    """Ten seconds of tone and noise through separation in windows: the voice must come out, loud enough and near the whole."""
    import numpy as np

    from cadenza.operators import waves

    t = np.arange(160_000) / 16_000
    x = 0.3 * np.sin(2 * np.pi * 220 * t) + 0.01 * np.random.default_rng(0).normal(size=len(t))
    chunks = waves.chunked(spark.createDataFrame([("smoke", 16_000, waves.pcm16(x.astype(np.float32)))], "sid string, sr int, pcm binary"))
    vocals, failed = waves.separated(chunks, make or waves.MiddleOut, 48_000, 8_000)
    ok = failed.isEmpty() and bool(waves.guarded(chunks, vocals).first()["passed"])
    print("separation", "passes" if ok else "fails")
    return ok


def _workspace(spark, path: str) -> pipeline.Workspace:
    project = parse_project(Path(path).read_text())
    return pipeline.Workspace(spark, project, project.makers())


def main(args: list[str]) -> int:
    if args[:1] == ["doctor"] and len(args) <= 2:
        return doctor(*args[1:])
    if len(args) == 2 and args[0] == "projects":
        print("\n".join(list_projects(args[1])))
        return 0
    known = {*pipeline.STAGES, *pipeline.ALIASES}
    if len(args) == 2 and args[0] == "all" or len(args) == 3 and args[0] in ("plan", "apply") and args[1] in known:
        w = _workspace(session(), args[-1])
        if args[0] == "all":
            print(pipeline.run_all(w, pipeline.MAIN))
        elif args[0] == "apply":
            print(pipeline.apply(w, args[1]))
        else:
            for name, df in pipeline.plan(w, args[1]).items():
                print(name)
                df.show(20, False)
        return 0
    print(__doc__)
    return 2


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
