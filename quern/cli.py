"""Commands, one for each stage; results as JSON."""

from __future__ import annotations

import argparse
import json
import sys
from functools import reduce

from pyspark.sql import DataFrame

from quern.operators.curate import grouped_scan
from quern.operators.export import check_jsonl
from quern.operators.generate import Bundle
from quern.operators.selection import Rule
from quern.plans import stages
from quern.plans.registry import Registry
from quern.session import get_session
from quern.sources import archive


_WORKERS = {"--workers": {"type": int, "help": "partitions that call side by side"}}
_LIKE = {"--prompt-version-like": {"default": "%"}}
_COMMIT = {"--commit-rows": {"type": int, "default": 1000}}
#: Of each command the arguments and the options.
COMMANDS: dict[str, tuple[tuple[str, ...], dict[str, dict]]] = {
    "init-db": ((), {}),
    "fetch-snapshot": (("source", "folder"), {}),
    "unpack-snapshot": (("source", "target"), {}),
    "ingest-snapshot": (("path",), {"--source-name": {"default": "local"}, "--no-resume": {"action": "store_true"}, "--chunk-lines": {"type": int, "default": 1_000_000}}),
    "assemble-entries": ((), {"--lang": {"action": "append"}, "--limit-groups": {"type": int}, "--replace": {"action": "store_true"}, "--frequencies": {"help": "Parquet of token and zipf"}, "--min-zipf": {"type": float}, "--phrase-min-zipf": {"type": float}}),
    "generate-definitions": ((), {**_WORKERS, **_COMMIT, "--threads": {"type": int, "default": 1}, "--limit": {"type": int}, "--recompute": {"action": "store_true"}, "--max-retries": {"type": int, "default": 3}}),
    "audit-definitions": ((), {**_LIKE, "--sample": {"type": int}, "--bucket-size": {"type": int, "default": 1000}}),
    "review-definitions": ((), {**_WORKERS, **_COMMIT, **_LIKE, "--sample-size": {"type": int, "default": 1000}, "--sample-seed": {"default": "review-v1"}, "--review-version": {"default": "review_v1"}, "--judge-model": {"default": "fake"}}),
    "review-report": ((), {"--sample-seed": {"default": "review-v1"}, "--review-version": {"default": "review_v1"}}),
    "export-audit": (("path",), {"--enriched-only": {"action": "store_true"}}),
    "export-distribution": (("path",), {"--parts": {"action": "store_true"}, "--fallback-template": {"action": "append", "default": [], "help": "older templates, newest first"}}),
    "export-distribution-sqlite": (("path",), {"--fallback-template": {"action": "append", "default": []}}),
    "validate-distribution": (("path",), {}),
    "run": (("path", "folder"), {"--tiers": {"type": int, "nargs": "+", "default": [8]}}),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quern")
    p.add_argument("--store", default="quern-store", help="folder of the registry's tables")
    p.add_argument("--language", nargs=2, default=("zh-Hans", "Chinese (Simplified)"), metavar=("CODE", "NAME"))
    p.add_argument("--template", default="v1", help="template version of the prompts")
    sub = p.add_subparsers(dest="command", required=True)
    for name, (positional, options) in COMMANDS.items():
        command = sub.add_parser(name)
        for argument in positional:
            command.add_argument(argument)
        for flag, settings in options.items():
            command.add_argument(flag, **settings)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "fetch-snapshot":
        out = vars(archive.register(a.source, a.folder))
    elif a.command == "unpack-snapshot":
        out = {"path": archive.unpack(a.source, a.target)}
    else:
        spark = get_session("quern-cli")
        registry, bundle = Registry(spark, a.store), Bundle(a.template, *a.language)
        bundles = [bundle, *(Bundle(t, *a.language) for t in getattr(a, "fallback_template", ()))]
        shown = lambda reports: {k: {"count": v.count(), "shown": [r.asDict() for r in v.limit(100).collect()]} for k, v in reports.items()}

        def assemble() -> dict:
            chosen = None
            if a.frequencies:
                words, heads = spark.read.parquet(a.frequencies), grouped_scan(registry.table("raw").read(), a.lang)
                chosen = reduce(DataFrame.unionByName, [Rule(lang, a.template, a.min_zipf or 0.0, a.phrase_min_zipf).apply(heads, words) for lang in a.lang or ["en"]])
            return stages.assemble(registry, languages=a.lang, selected=chosen, limit_groups=a.limit_groups, replace=a.replace)

        out = {
            "init-db": lambda: {"applied": registry.init()},
            "ingest-snapshot": lambda: stages.ingest(registry, a.path, source_name=a.source_name, resume=not a.no_resume, chunk_lines=a.chunk_lines),
            "assemble-entries": assemble,
            "generate-definitions": lambda: stages.generate_definitions(registry, bundle, limit=a.limit, recompute=a.recompute, commit_rows=a.commit_rows, workers=a.workers, threads=a.threads, max_retries=a.max_retries),
            "audit-definitions": lambda: shown(stages.audit_definitions(registry, a.sample, version_like=a.prompt_version_like, bucket_size=a.bucket_size)),
            "review-definitions": lambda: stages.review(registry, size=a.sample_size, seed=a.sample_seed, version=a.review_version, model=a.judge_model, version_like=a.prompt_version_like, language=a.language[1], workers=a.workers, commit_rows=a.commit_rows),
            "review-report": lambda: shown(stages.review_reports(registry, a.review_version, a.sample_seed)),
            "export-audit": lambda: stages.export_audit(registry, a.path, include_missing=not a.enriched_only),
            "export-distribution": lambda: stages.export_distribution(registry, bundles, a.path, parts=a.parts),
            "export-distribution-sqlite": lambda: stages.export_sqlite(registry, bundles, a.path),
            "validate-distribution": lambda: {"documents": check_jsonl(spark, a.path)},
            "run": lambda: stages.workflow(registry, a.path, bundle, a.folder, tiers=tuple(a.tiers)),
        }[a.command]()
    print(json.dumps(out, ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
