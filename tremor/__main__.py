import sys

from tremor.cli import main

sys.exit(main())
