import sys

from capture_lake.cli import main

sys.exit(main())
