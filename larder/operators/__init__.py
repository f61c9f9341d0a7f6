"""DataFrame-to-DataFrame operators that know nothing about storage."""
