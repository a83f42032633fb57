"""DataFrame-to-DataFrame operators. All are lazy but for ``manifest.number_files``."""
