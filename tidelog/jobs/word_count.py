"""word_count INPUT OUTPUT: word counts of text files as CSV."""

from __future__ import annotations

from tidelog.jobs.command import run_command
from tidelog.plans.flows import run_word_count

if __name__ == "__main__":
    run_command("word count", ["INPUT", "OUTPUT"], run_word_count)
