"""``python -m entryflow <job> ...`` (see ``entryflow.cli``)."""

from entryflow.cli import run

run()
