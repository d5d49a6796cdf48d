"""Launcher for spark-submit: ``spark-submit --py-files ledgerlake.zip run_job.py <job> ...``."""

from ledgerlake.jobs import main

if __name__ == "__main__":
    main()
