"""Reading and writing: releases, landed tables, reports."""
