"""``python -m ferry ...`` runs the command line (see ``ferry/cli.py``)."""

import sys

from ferry.cli import main

sys.exit(main())
