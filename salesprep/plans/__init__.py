"""The whole jobs: country extract, region preparation, publishing."""
