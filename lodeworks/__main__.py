"""Run a job: ``spark-submit ... lodeworks/__main__.py <job> key=value ... --out <path>``.

Every parameter of the job's function is a ``key=value`` pair; lists are written
``ranks=4,8``. The result goes to ``--out`` as parquet, CSV or text lines, or is shown.
"""

from __future__ import annotations

import argparse
import inspect
from collections.abc import Callable, Sequence

from lodeworks.plans.jobs import JOBS
from lodeworks.session import build_session
from lodeworks.sources import write_lines, write_table


def parameters(job: Callable, pairs: Sequence[str]) -> dict[str, object]:
    """Typed arguments for the job from ``key=value`` texts."""
    known = inspect.signature(job).parameters
    given = {}
    for pair in pairs:
        key, sep, text = pair.partition("=")
        if not sep or key not in known or key == "spark":
            raise SystemExit(f"unknown parameter {pair!r}; known: {', '.join(list(known)[1:])}")
        given[key] = _value(known[key].default, text)
    missing = [k for k, p in known.items() if p.default is p.empty and k != "spark" and k not in given]
    if missing:
        raise SystemExit(f"missing: {', '.join(missing)}")
    return given


def _value(default: object, text: str) -> object:
    if isinstance(default, tuple):
        return [type(default[0])(part) for part in text.split(",")]
    if isinstance(default, bool):
        return text.lower() in ("1", "true", "yes")
    if isinstance(default, (int, float)):
        return type(default)(text)
    if default is None:
        return int(text)
    return text


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lodeworks", description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("parameters", nargs="*", metavar="key=value")
    parser.add_argument("--out", help="new folder for the result")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv", "text"])
    parser.add_argument("--master", help="only for local runs; spark-submit sets it otherwise")
    args = parser.parse_args(argv)
    job = JOBS[args.job]
    given = parameters(job, args.parameters)
    result = job(build_session(f"lodeworks {args.job}", args.master), **given)
    if args.out is None:
        result.show(50, truncate=False)
    elif args.format == "text":
        write_lines(result, args.out)
    else:
        write_table(result, args.out, args.format)


if __name__ == "__main__":
    main()
