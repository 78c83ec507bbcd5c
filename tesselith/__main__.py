"""python -m tesselith SLIDE... : extract patches, or preview them, inspect inputs, show settings."""

from __future__ import annotations

import argparse
import os
import sys

from .config import dumped, load_config


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("tesselith", description="Patches from slides, by Spark")
    p.add_argument("inputs", nargs="*", help="paths of slides")
    p.add_argument("--input-list", help="a .txt file with a path a line")
    p.add_argument("--input-root", help="where relative paths begin")
    p.add_argument("--config", help="settings, YAML or JSON")
    p.add_argument("--output", help="instead of output.root, or of preview.root with --preview")
    what = p.add_mutually_exclusive_group()
    what.add_argument("--preview", action="store_true", help="contours and sample patches only")
    what.add_argument("--center-preview", action="store_true", help="thumbnails and masks only")
    p.add_argument("--n-patches", type=int, help="sample patches of a preview")
    p.add_argument("--inspect", action="store_true", help="resolve inputs, open nothing")
    p.add_argument("--show-config", action="store_true", help="print the settings")
    p.add_argument("--run-id")
    p.add_argument("--set", action="append", default=[], metavar="KEY=VALUE", help="override a setting")
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    a = arguments().parse_args(argv)
    sets = list(a.set)
    if a.output:
        sets.append(f"{'preview' if a.preview else 'output'}.root={a.output}")
    if a.n_patches is not None:
        sets.append(f"preview.n_patches={a.n_patches}")
    config = load_config(a.config, tuple(sets))
    if a.show_config:
        print(dumped(config), end="")
        return 0
    if a.input_list and a.inputs:
        raise SystemExit("paths or --input-list, not both")
    if not a.input_list and not a.inputs:
        raise SystemExit("a path or --input-list is needed")
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("tesselith").getOrCreate()
    from . import api

    try:
        slides = api.parse_inputs(spark, a.input_list or [os.path.abspath(p) if not a.input_root else p for p in a.inputs], a.input_root)
    except (OSError, ValueError) as e:
        raise SystemExit(f"inputs: {e}") from e
    if a.inspect:
        for r in slides.orderBy("ordinal").toLocalIterator():
            print(f"{r.slide_id}\tsource={r.source}\tentrypoint={r.entrypoint}\tsidecars={','.join(r.sidecars) or '-'}")
        return 0
    run = api.center_preview if a.center_preview else api.run_preview if a.preview else api.extract
    result = run(spark, slides, config, a.run_id)
    planned = f" planned_patches={result.summary['patches']}" if a.preview else ""
    print(f"status={result.status} slides={result.summary['slides']}{planned} output={result.output_root} log={result.log}")
    return 0 if result.status == "success" else 1


if __name__ == "__main__":
    sys.exit(main())
