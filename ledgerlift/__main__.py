import sys

from ledgerlift.cli import main

sys.exit(main())
