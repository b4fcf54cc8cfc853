"""Run one of the command line jobs: ``spark-submit job.py <job> <input> <output>``."""

from partwise.jobs import main

if __name__ == "__main__":
    main()
