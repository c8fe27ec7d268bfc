"""``python -m viaduct <stage> ...``: the end-to-end runner (see ``plans.run``)."""

from .plans.run import main

if __name__ == "__main__":
    main()
