"""barloom.streaming"""
