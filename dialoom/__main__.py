"""Command line: ``python -m dialoom COMMAND``."""

from __future__ import annotations

import argparse

from .operators import annotations
from .session import build_session, share_package
from .sources import archive as store
from .sources import exports


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="dialoom")
    parser.add_argument("--archive", help="folder of the archive")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("init")
    sub.add_parser("reset").add_argument("--confirm", action="store_true")
    for name in ("import", "run"):
        p = sub.add_parser(name)
        p.add_argument("--chatgpt")
        p.add_argument("--claude")
        p.add_argument("--assume-immutable", action="store_true")
        p.add_argument("--incremental", action="store_true")
    sub.add_parser("build")
    sub.add_parser("annotate")
    sub.add_parser("stats")
    q = sub.add_parser("query-annotations")
    q.add_argument("entity_type", choices=annotations.ENTITY_TYPES)
    for option in ("--key", "--value", "--value-type", "--output"):
        q.add_argument(option)
    args = parser.parse_args(argv)
    spark = build_session()
    share_package(spark)
    archive = store.Archive(spark, args.archive)
    inputs = {p: getattr(args, p) for p in exports.PLATFORMS if getattr(args, p, None)}
    if args.command == "init":
        archive.init()
    elif args.command == "reset":
        archive.reset(args.confirm)
    elif args.command == "import":
        archive.init()
        for platform, path in inputs.items():
            print(platform, store.import_into(archive, exports.read_export(spark, path), platform, args.assume_immutable, args.incremental))
    elif args.command == "build":
        store.build_pairs(archive)
    elif args.command == "annotate":
        store.annotate(archive)
    elif args.command == "stats":
        store.stats(archive).show(truncate=False)
    elif args.command == "run":
        store.run(archive, inputs, args.assume_immutable, args.incremental).show(truncate=False)
    else:
        annotations.query(archive.load("annotations"), args.entity_type, args.key, args.value, args.value_type, args.output).show(truncate=False)


if __name__ == "__main__":
    main()
