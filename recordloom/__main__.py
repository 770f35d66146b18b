"""``python -m recordloom module:factory [folder]``: one run with the settings of the environment.

With the folder of a run that failed, that run goes on where it stopped.
"""

from __future__ import annotations

import importlib
import sys
import traceback

from pyspark.sql import SparkSession

from recordloom.backends.base import BackendFactory
from recordloom.plans.run import run
from recordloom.settings import from_env


def backend_named(text: str) -> BackendFactory:
    """The backend factory at ``module:name``."""
    module, colon, name = text.partition(":")
    if not (module and colon and name):
        raise ValueError(f"a backend is named module:name, not {text!r}")
    return getattr(importlib.import_module(module), name)


def main(arguments: list[str], spark: SparkSession | None = None) -> int:
    """0 after a run (also one without prompts), 1 after any failure, 2 for a wrong call.

    A session that is handed in stays open; its own one is stopped at the end.
    """
    if len(arguments) not in (1, 2):
        print("usage: python -m recordloom module:factory [folder of a run]", file=sys.stderr)
        return 2
    session = spark
    try:
        config, factory = from_env(), backend_named(arguments[0])
        session = session or SparkSession.builder.appName("recordloom").getOrCreate()
        print(run(session, config, factory, resume=arguments[1] if arguments[1:] else None))
        return 0
    except Exception:
        traceback.print_exc()
        return 1
    finally:
        if spark is None and session is not None:
            session.stop()


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
