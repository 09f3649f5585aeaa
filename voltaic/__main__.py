"""``python -m voltaic ...`` is the command line of :mod:`voltaic.cli`."""

import sys

from .cli import main

sys.exit(main())
