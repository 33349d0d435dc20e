"""spark-submit entry point; see civitally.plans.jobs."""

from civitally.plans.jobs import main

if __name__ == "__main__":
    main()
