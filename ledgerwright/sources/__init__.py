"""Where planning tables come from and where they are written."""
